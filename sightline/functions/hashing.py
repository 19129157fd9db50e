"""Canonical JSON text, content hashes and stable ids built from column expressions."""

from functools import reduce

from pyspark.sql import Column, functions as F


def json_text(value: Column) -> Column:
    """JSON atom of a string, date or boolean column; ``null`` where it is missing."""
    listed = F.to_json(F.array(value))
    return F.when(value.isNull(), "null").otherwise(listed.substr(F.lit(2), F.length(listed) - 2))


def json_number(value: Column) -> Column:
    """JSON atom of a numeric column: its shortest digits, as an integer where it is whole, with an exponent only
    below 0.0001.  Whole doubles past the range of a long are padded with zeros."""
    number = value.cast("double")
    whole = number == F.rint(number)
    small = whole & (F.abs(number) < 9.2e18)
    shown = number.cast("string")
    # most numbers are whole or have few digits; only the others go through the digits one by one
    brief = (F.length(shown) < 17) & ~shown.contains("E")
    return (F.when(value.isNull(), "null").when(small, number.cast("long").cast("string")).when(brief, shown)
            .otherwise(long_number(number, shown)))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` takes it."""
    return F.transform(F.array(value), use)[0]


def long_number(number: Column, shown: Column) -> Column:
    """JSON atom of a double with an exponent or very many digits."""
    # some Java versions print 17 digits where 16 tell the number
    long = F.length(F.regexp_replace(shown, r"^[-0.]+|E.*$|\.", "")) >= 17
    short = F.when(long, F.format_string("%.15e", number))
    text = F.when(short.try_cast("double") == number, F.upper(short)).otherwise(shown)

    def plain(parts):
        sign, digits, power = parts["sign"], parts["digits"], parts["power"]
        point = F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise("")
        return F.concat(sign, F.when(power < -4, F.concat(F.substring(digits, 1, 1), point, F.lit("e-"), F.lpad(F.abs(power).cast("string"), 2, "0")))
                        .when(power < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits))
                        .when(F.length(digits) <= power + 1, F.rpad(digits, power + 1, "0"))
                        .otherwise(F.concat(F.substr(digits, F.lit(1), power + 1), F.lit("."), F.substr(digits, power + 2))))

    def whole(text):
        part = lambda k: F.regexp_extract(text, r"^(-?)([0-9])\.([0-9]+)E([+-]?[0-9]+)$", k)
        parts = F.struct(part(1).alias("sign"), F.concat(part(2), F.regexp_replace(part(3), "0+$", "")).alias("digits"), part(4).try_cast("int").alias("power"))
        return F.when(text.contains("E"), bound(parts, plain)).otherwise(text)

    return bound(text, whole)


def json_array(atoms: list[Column]) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *atoms), F.lit("]"))


def json_object(atoms: dict[str, Column]) -> Column:
    """JSON object with its keys in sorted order; values are ready-made atoms."""
    pairs = [F.concat(F.lit(f'"{name}":'), atoms[name]) for name in sorted(atoms)]
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def atom(value: Column, kind: str) -> Column:
    """JSON atom for a column of the given simple Spark type name."""
    if kind in ("double", "float", "int", "integer", "bigint", "long", "smallint", "short", "byte", "tinyint"):
        return json_number(value)
    if kind == "boolean":
        return F.when(value.isNull(), "null").otherwise(value.cast("string"))
    if kind.startswith(("array", "map", "struct")):
        return F.when(value.isNull(), "null").otherwise(F.to_json(value, {"ignoreNullFields": "false"}))
    return json_text(value.cast("string"))


def row_hash(df, columns: list[str], as_object: bool = False) -> Column:
    """SHA-256 over the canonical JSON of the named columns of ``df``."""
    kinds = dict(df.dtypes)
    atoms = {name: atom(F.col(f"`{name}`"), kinds[name]) for name in columns}
    return F.sha2(json_object(atoms) if as_object else json_array(list(atoms.values())), 256)


def stable_id(prefix: str, identity: dict[str, Column]) -> Column:
    """``prefix_`` followed by the first 24 hex digits of the hash of the identity object."""
    text = json_object({name: json_text(value) for name, value in identity.items()})
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(text, 256), 1, 24))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


# Fixed formats.
ID_FORMAT = r"^[A-Za-z][A-Za-z0-9._:-]{0,127}$"
REFERENCE_FORMAT = r"^[A-Za-z0-9][A-Za-z0-9._:/-]{0,199}$"
HASH_FORMAT = r"^[0-9a-f]{64}$"


def is_identifier(value: Column) -> Column:
    return F.coalesce(value.rlike(ID_FORMAT), F.lit(False))


def is_reference(value: Column) -> Column:
    return F.coalesce(value.rlike(REFERENCE_FORMAT), F.lit(False))


def is_hash(value: Column) -> Column:
    return F.coalesce(value.rlike(HASH_FORMAT), F.lit(False))
