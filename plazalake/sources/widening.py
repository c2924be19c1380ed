"""Common types of two schemas that keep every value (IO14).

Types form a lattice: whole numbers widen to wider ones, to decimals with room for all
digits, and to doubles where these hold every value; decimals widen to decimals.
Where no type holds all values of both, such as 64-bit whole numbers beside fractions,
the nearest types are tried in turn, and the first that changes no value there is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StructField,
    StructType,
    TimestampType,
)

#: Digits of whole numbers, narrow ones first.
DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}
MOST_DIGITS = 38
#: Fraction digits of a decimal that stands for doubles.
FRACTION = 18
_WHOLE, _FRACTIONS = tuple(DIGITS), (FloatType(), DoubleType())


def _decimal(whole: int, scale: int) -> DecimalType:
    """Room for ``whole`` digits before the point where there is any."""
    scale = min(scale, MOST_DIGITS)
    return DecimalType(min(whole + scale, MOST_DIGITS), scale)


def candidates(a: DataType, b: DataType) -> list[DataType]:
    """The common types of two different simple types, best first; none if there is none."""
    if a in _WHOLE and b in _WHOLE:
        return [max(a, b, key=DIGITS.__getitem__)]
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        return [_decimal(max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale))]
    for one, other in ((a, b), (b, a)):
        if one in _WHOLE and isinstance(other, DecimalType):
            return [_decimal(max(DIGITS[one], other.precision - other.scale), other.scale)]
        if one in _WHOLE and other in _FRACTIONS:
            exact = [DecimalType(MOST_DIGITS, FRACTION)] if one == LongType() else []
            return [DoubleType(), *exact]
        if one in _FRACTIONS and isinstance(other, DecimalType):
            return [DecimalType(MOST_DIGITS, max(FRACTION, other.scale)), DoubleType()]
    if a in _FRACTIONS and b in _FRACTIONS:
        return [DoubleType()]
    if {a, b} == {DateType(), TimestampType()}:
        return [TimestampType()]
    return []


def may_change(held: DataType, wanted: DataType) -> bool:
    """Whether some value of ``held`` may have no equal in ``wanted``, of its ``candidates``."""
    if held == wanted:
        return False
    if isinstance(held, StructType):
        kinds = {f.name.lower(): f.dataType for f in wanted}
        return any(may_change(f.dataType, kinds[f.name.lower()]) for f in held)
    if isinstance(held, ArrayType):
        return may_change(held.elementType, wanted.elementType)
    if isinstance(held, MapType):
        return may_change(held.valueType, wanted.valueType)
    if isinstance(held, DecimalType) and isinstance(wanted, DecimalType):
        return wanted.precision - wanted.scale < held.precision - held.scale or wanted.scale < held.scale
    if held in _WHOLE and isinstance(wanted, DecimalType):
        return wanted.precision - wanted.scale < DIGITS[held]
    pair = held == LongType() and wanted == DoubleType()
    return pair or isinstance(held, DecimalType) or (held in _FRACTIONS and isinstance(wanted, DecimalType))


def merged_type(held: DataType, new: DataType, place: str = "", choice: int = 0) -> DataType:
    """The type that takes the values of both: structs field by field, whatever their names' case.

    ``choice`` picks among ``candidates``, the last one where there are fewer. Types
    without a common one raise.
    """
    if held == new or isinstance(new, NullType):
        return held
    if isinstance(held, NullType):
        return new
    if isinstance(held, StructType) and isinstance(new, StructType):
        fields = {f.name.lower(): (f.name, f.dataType) for f in held}
        for f in new:
            name, known = fields.get(f.name.lower(), (f.name, f.dataType))
            inner = f"{place}.{name}" if place else name
            fields[f.name.lower()] = (name, merged_type(known, f.dataType, inner, choice))
        return StructType([StructField(name, kind) for name, kind in fields.values()])
    if isinstance(held, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(merged_type(held.elementType, new.elementType, f"{place}[]", choice))
    if isinstance(held, MapType) and isinstance(new, MapType) and held.keyType == new.keyType:
        return MapType(held.keyType, merged_type(held.valueType, new.valueType, f"{place}{{}}", choice))
    found = candidates(held, new)
    if not found:
        raise TypeError(
            f"{place or 'column'}: {held.simpleString()} and {new.simpleString()} have no common type"
        )
    return found[min(choice, len(found) - 1)]


def fitted(value: Column, held: DataType, wanted: DataType) -> Column:
    """``value`` of type ``held`` as ``wanted``; NULL where it has no room."""
    if held == wanted:
        return value
    if isinstance(held, StructType) and isinstance(wanted, StructType):
        known = {f.name.lower(): f for f in held}
        fields = [
            (
                fitted(value[known[f.name.lower()].name], known[f.name.lower()].dataType, f.dataType)
                if f.name.lower() in known
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in wanted
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(held, ArrayType):
        return F.transform(value, lambda x: fitted(x, held.elementType, wanted.elementType))
    if isinstance(held, MapType):
        return F.transform_values(value, lambda _, x: fitted(x, held.valueType, wanted.valueType))
    return value.try_cast(wanted)


def fitted_frame(df: DataFrame, wanted: StructType) -> DataFrame:
    known = {f.name.lower(): f for f in df.schema}
    return df.select(
        *(
            (
                fitted(F.col(f"`{known[f.name.lower()].name}`"), known[f.name.lower()].dataType, f.dataType)
                if f.name.lower() in known
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in wanted
        )
    )


def _changed(value: Column, held: DataType, wanted: DataType) -> Column:
    """Whether ``value`` is another one after the way to ``wanted`` and back."""
    if isinstance(held, MapType):
        return F.exists(F.map_values(value), lambda x: _changed(x, held.valueType, wanted.valueType))
    if isinstance(held, ArrayType):
        return F.exists(value, lambda x: _changed(x, held.elementType, wanted.elementType))
    if isinstance(held, StructType):
        kinds = {f.name.lower(): f.dataType for f in wanted}
        parts = [
            F.coalesce(_changed(value[f.name], f.dataType, kinds[f.name.lower()]), F.lit(False))
            for f in held
            if may_change(f.dataType, kinds[f.name.lower()])
        ]
        found = F.lit(False)
        for part in parts:
            found = found | part
        return found
    there = fitted(value, held, wanted)
    return ~there.try_cast(held).eqNullSafe(value)


def check_kept(wanted: StructType, *frames: DataFrame) -> StructType:
    """``wanted``, with other candidates for the columns in which it would change a value of
    ``frames``; raises if those would change one as well. Reads only columns in doubt."""
    for choice in (0, 1):
        doubtful = {
            f.name: [df for df in frames if _kind(df, f.name) not in (None, f.dataType) and may_change(_kind(df, f.name), f.dataType)]
            for f in wanted
        }
        lost = [f for f in wanted if any(_loses(df, f) for df in doubtful[f.name])]
        if not lost:
            return wanted
        if choice:
            raise ValueError(f"{lost[0].name}: {lost[0].dataType.simpleString()} would change a value")
        again = {}
        for f in lost:
            kinds = [k for k in (_kind(df, f.name) for df in frames) if k is not None]
            again[f.name] = merged_type(kinds[0], kinds[-1], f.name, 1)
        wanted = StructType([StructField(f.name, again.get(f.name, f.dataType)) for f in wanted])
    return wanted


def _kind(df: DataFrame, name: str) -> DataType | None:
    return next((f.dataType for f in df.schema if f.name.lower() == name.lower()), None)


def _loses(df: DataFrame, field: StructField) -> bool:
    held = _kind(df, field.name)
    return not df.where(_changed(F.col(f"`{field.name}`"), held, field.dataType)).isEmpty()
