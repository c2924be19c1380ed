"""Chat formatting by schema fingerprints (DataFrame functions only).

Records of unlike layouts come as JSON text. The set of a record's nested field paths
is hashed; the hash picks a declarative mapping that says where its turns, roles and
texts lie. The turns are then written with one template and a loss mask, and can be
read back from the output.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import empty_if_null

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    ``turns``: name of the array of turns with its role and text fields, and the
    aliases of roles; or ``fields``: (role, field) of each turn in order.
    """

    paths: tuple[str, ...]
    turns: str | None = None
    role: str = ""
    text: str = ""
    aliases: tuple[tuple[str, str], ...] = ()
    fields: tuple[tuple[str, str], ...] = ()

    @property
    def fingerprint(self) -> str:
        return hashlib.md5("\n".join(sorted(self.paths)).encode()).hexdigest()


LAYOUTS = {
    "messages": Layout(
        ("messages", "messages.role", "messages.content"), "messages", "role", "content"
    ),
    "conversations": Layout(
        ("conversations", "conversations.from", "conversations.value"),
        "conversations",
        "from",
        "value",
        (("human", "user"), ("gpt", "assistant")),
    ),
    "prompt": Layout(
        ("prompt", "completion"), fields=(("user", "prompt"), ("assistant", "completion"))
    ),
    "instruction": Layout(
        ("system", "instruction", "output"),
        fields=(("system", "system"), ("user", "instruction"), ("assistant", "output")),
    ),
}


def _schema() -> str:
    fields = []
    for layout in LAYOUTS.values():
        if layout.turns:
            fields.append(f"`{layout.turns}` array<struct<`{layout.role}`:string,`{layout.text}`:string>>")
        else:
            fields += [f"`{name}` string" for _, name in layout.fields]
    return ", ".join(dict.fromkeys(fields))


def _probe() -> str:
    """Objects where layouts have turns, and where they have text."""
    fields = []
    for layout in LAYOUTS.values():
        if layout.turns:
            fields.append(f"`{layout.turns}` array<map<string,string>>")
        else:
            fields += [f"`{name}` map<string,string>" for _, name in layout.fields]
    return ", ".join(dict.fromkeys(fields))


def field_paths(record: Column) -> Column:
    """Sorted names of the top fields of a JSON object and, below the fields of layouts, of
    the objects there: of all objects of an array, so that one unlike turn shows."""
    none = F.array().cast("array<string>")
    probed = F.from_json(record, _probe())

    def below(name: str, inside: Column) -> Column:
        return F.transform(F.coalesce(inside, none), lambda key: F.concat(F.lit(f"{name}."), key))

    nested = []
    for layout in LAYOUTS.values():
        if layout.turns:
            every = F.transform(probed[layout.turns], lambda turn: F.coalesce(F.map_keys(turn), none))
            nested.append(below(layout.turns, F.flatten(every)))
        else:
            nested += [below(name, F.map_keys(probed[name])) for _, name in layout.fields]
    top = F.coalesce(F.json_object_keys(record), none)
    return F.array_sort(F.array_distinct(F.concat(top, *nested)))


def fingerprint(record: Column) -> Column:
    return F.md5(F.concat_ws("\n", field_paths(record)))


def canonical_turns(record: Column) -> Column:
    """Array of (role, text) of a JSON record; null if no mapping has its fingerprint."""
    parsed = F.from_json(record, _schema())
    known = fingerprint(record)
    cases = None
    for layout in LAYOUTS.values():
        turns = _turns(parsed, layout).cast(TURNS)
        hit = known == layout.fingerprint
        cases = F.when(hit, turns) if cases is None else cases.when(hit, turns)
    return cases


def _turns(parsed: Column, layout: Layout) -> Column:
    if not layout.turns:
        return F.array(
            *(
                F.struct(F.lit(role).alias("role"), empty_if_null(parsed[name]).alias("text"))
                for role, name in layout.fields
            )
        )

    def turn(item: Column) -> Column:
        role = reduce(
            lambda other, alias: F.when(item[layout.role] == alias[0], alias[1]).otherwise(other),
            layout.aliases,
            item[layout.role],
        )
        return F.struct(empty_if_null(role).alias("role"), empty_if_null(item[layout.text]).alias("text"))

    return F.transform(parsed[layout.turns], turn)


#: The template's control strings around the turns of each role; other roles are named.
MARKS = {
    "system": ("[SYS]", "[/SYS]"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
NAME_OPEN, NAME_CLOSE, NAMED_END = "[TURN]", "[/TURN]", "[END]"
LEARNED = "assistant"
_CONTROL = r"(/?(?:SYS\]|INST\]|TURN\]|s>)|END\])"


def escape(text: Column) -> Column:
    """One backslash more behind the first character of each control string in a text."""
    return F.regexp_replace(text, r"([\[<])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<])\\(\\*)" + _CONTROL, r"$1$2$3")


def _opening(role: Column) -> Column:
    named = F.concat(F.lit(NAME_OPEN), escape(role), F.lit(NAME_CLOSE))
    return reduce(lambda rest, m: F.when(role == m[0], m[1][0]).otherwise(rest), MARKS.items(), named)


def _closing(role: Column) -> Column:
    return reduce(
        lambda rest, m: F.when(role == m[0], m[1][1]).otherwise(rest), MARKS.items(), F.lit(NAMED_END)
    )


def format_turns(turns: Column) -> Column:
    """Struct of ``formatted`` and ``loss``, the (start, length) in code points of each
    learned text, as it stands in the output."""

    def step(state: Column, turn: Column) -> Column:
        body = escape(turn["text"])
        start = state["at"] + F.length(_opening(turn["role"]))
        spans = F.when(
            turn["role"] == LEARNED,
            F.concat(
                state["loss"],
                F.array(F.struct(start.alias("start"), F.length(body).alias("length"))),
            ),
        ).otherwise(state["loss"])
        return F.struct(
            (start + F.length(body) + F.length(_closing(turn["role"]))).alias("at"), spans.alias("loss")
        )

    pieces = F.transform(
        turns, lambda t: F.concat(_opening(t["role"]), escape(t["text"]), _closing(t["role"]))
    )
    begin = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss")
    )
    return F.struct(
        F.concat_ws("", pieces).alias("formatted"),
        F.aggregate(turns, begin, step)["loss"].alias("loss"),
    )


def _one_turn() -> str:
    whole = [rf"\Q{a}\E.*?\Q{b}\E" for a, b in MARKS.values()]
    named = rf"\Q{NAME_OPEN}\E.*?\Q{NAME_CLOSE}\E.*?\Q{NAMED_END}\E"
    return "(?s)" + "|".join([*whole, named])


def read_turns(formatted: Column) -> Column:
    """The turns that ``format_turns`` wrote, from its output alone."""
    pieces = F.regexp_extract_all(formatted, F.lit(_one_turn()), F.lit(0))

    def turn(piece: Column) -> Column:
        role, start, end = (
            unescape(F.regexp_extract(piece, rf"(?s)^\Q{NAME_OPEN}\E(.*?)\Q{NAME_CLOSE}\E", 1)),
            F.locate(NAME_CLOSE, piece) + len(NAME_CLOSE),
            F.lit(len(NAMED_END)),
        )
        for name, (opening, closing) in MARKS.items():
            hit = piece.startswith(opening)
            role = F.when(hit, name).otherwise(role)
            start = F.when(hit, len(opening) + 1).otherwise(start)
            end = F.when(hit, len(closing)).otherwise(end)
        text = F.substring(piece, start, F.length(piece) - start - end + 1)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.concat_ws(
        "",
        F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))),
    )


def records_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, record): each conversation as a JSON record in one of the layouts.

    The layout follows from the key and the roles: a layout without an array of turns
    only takes conversations with just its roles. Turns are ordered by turn, then role
    and text; a null turn comes first, a null text or role counts as empty, a null
    conv_id is a conversation of its own.
    """
    turns = conversations.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("turn").isNotNull().alias("numbered"),
                    "turn",
                    empty_if_null("role").alias("role"),
                    empty_if_null("text").alias("text"),
                )
            )
        ).alias("turns")
    )
    roles = F.transform("turns", lambda t: t["role"])
    pick = F.pmod(F.xxhash64(F.col("conv_id")), F.lit(2))
    record = F.to_json(F.struct(F.transform("turns", lambda t: _renamed(t, "messages")).alias("messages")))
    plain = F.forall(roles, lambda r: r.isin("user", "assistant", "system"))
    record = F.when(
        plain & (pick == 1),
        F.to_json(F.struct(F.transform("turns", lambda t: _renamed(t, "conversations")).alias("conversations"))),
    ).otherwise(record)
    for layout in ("prompt", "instruction"):
        fields = LAYOUTS[layout].fields
        fits = roles == F.array(*(F.lit(role) for role, _ in fields))
        flat = F.to_json(
            F.struct(*(F.try_element_at("turns", F.lit(i + 1))["text"].alias(f) for i, (_, f) in enumerate(fields)))
        )
        record = F.when(fits, flat).otherwise(record)
    return turns.select("conv_id", record.alias("record"))


def _renamed(turn: Column, name: str) -> Column:
    layout = LAYOUTS[name]
    role = reduce(
        lambda other, alias: F.when(turn["role"] == alias[1], alias[0]).otherwise(other),
        layout.aliases,
        turn["role"],
    )
    return F.struct(role.alias(layout.role), turn["text"].alias(layout.text))


def format_records(records: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) of (conv_id, record).

    A record whose fingerprint has no mapping, a null one included, raises: it would
    be lost otherwise. An empty table gives an empty result.
    """
    turns = F.coalesce(
        canonical_turns(F.col("record")),
        F.raise_error(F.concat(F.lit("no mapping for "), F.coalesce("record", F.lit("null")))),
    )
    made = records.select("conv_id", turns.alias("turns"))
    return made.select("conv_id", format_turns(F.col("turns")).alias("out")).select("conv_id", "out.*")
