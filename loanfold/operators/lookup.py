"""Code tables and dimensions.

No broadcast is forced: Spark broadcasts a dimension when its size is below the session's limit and
otherwise shuffles, with adaptive skew handling. Dimensions are made unique first, so a lookup
never changes the number of rows. A code table of counted size becomes one dictionary that expressions look codes up in.
"""

from collections.abc import Mapping, Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType, StringType

from ..functions.flags import active
from .dedup import one_per_key


def dimension(df: DataFrame, key: str, columns: Sequence[str], active_only: bool = False) -> DataFrame:
    """One row per key with the given columns."""
    if active_only:
        df = df.filter(active())
    return one_per_key(df, key, columns)


def attach(df: DataFrame, dim: DataFrame, on: tuple[str, str],
           take: Mapping[str, str]) -> DataFrame:
    """Left-join a dimension that is unique on its key and take some of its columns under new names.

    on: (column of df, key of dim). take: new name -> column of dim.
    """
    left_col, key = on
    taken = {name: f"_take_{name}" for name in take if name in df.columns}
    side = dim.select(F.col(key).alias("_key"), *[F.col(c).alias(taken.get(n, n)) for n, c in take.items()])
    joined = df.join(side, F.col(left_col) == F.col("_key"), "left").drop("_key")
    if taken:
        joined = joined.drop(*taken).withColumnsRenamed({alias: name for name, alias in taken.items()})
    return joined


#: Slots of a dictionary: a lookup goes to the slot of the code's hash and compares the few codes in it.
SLOTS = 1024
#: Codes, and bytes of text, up to which a code table is sent to every task as a dictionary. A larger one is joined.
MOST_CODES, MOST_BYTES = 50_000, 4 << 20
_counted: WeakKeyDictionary = WeakKeyDictionary()


def fits_dictionary(source: DataFrame, text: str) -> bool:
    """Whether a code table is small enough, by its counted rows and bytes; counted once for each table object."""
    known = _counted.setdefault(source, {})
    if text not in known:
        size = source.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(text).cast("string"))).alias("bytes")).first()
        known[text] = size.n <= MOST_CODES and (size.bytes or 0) <= MOST_BYTES
    return known[text]


def dictionary(dim: DataFrame, key: str, value: str) -> Column:
    """The values of a table that is unique on its key, as one array of maps: slot -> code -> value.

    It is a scalar subquery: made once, whatever the number of columns that look codes up in it, and no join.
    """
    slot = F.pmod(F.hash(F.col(key)), F.lit(SLOTS)).alias("slot")
    entries = dim.filter(F.col(key).isNotNull()).groupBy(slot).agg(F.collect_list(F.struct(F.col(key), F.col(value))).alias("entries"))
    filled = entries.agg(F.map_from_entries(F.collect_list(F.struct("slot", "entries"))).alias("slots"))
    in_order = F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.map_from_entries(F.try_element_at("slots", i)))
    return filled.select(in_order).scalar()


def look_up(words: Column, code: Column) -> Column:
    """The value of a code in a dictionary; NULL for NULL and unknown codes. code must be of the key's type."""
    return F.try_element_at(F.get(words, F.pmod(F.hash(code), F.lit(SLOTS))), code)


def decode(df: DataFrame, types: DataFrame, labels: Mapping[str, str],
           text: str = "typedetaildescription", active_only: bool = False) -> DataFrame:
    """Replace codes by text: labels maps the new column to the code column it decodes.

    All columns look their codes up in one dictionary, so no code column costs a join. A code table beyond MOST_CODES or
    MOST_BYTES, and codes that are neither whole numbers nor text, are joined instead; the result is the same.
    """
    key = "typedetailid"
    dim = dimension(types, key, [text], active_only)
    of_key, kinds = types.schema[key].dataType, {c: df.schema[c].dataType for c in labels.values()}
    plain = all(k == of_key or isinstance(of_key, IntegralType) and isinstance(k, (IntegralType, StringType)) for k in kinds.values())
    if plain and fits_dictionary(types, text):
        words = dictionary(dim, key, text)
        return df.withColumns({name: look_up(words, F.col(code).try_cast(of_key)) for name, code in labels.items()})
    for name, code in labels.items():
        df = attach(df, dim, (code, key), {name: text})
    return df


def roll_up(df: DataFrame, *levels: tuple[DataFrame, tuple[str, str], Mapping[str, str]]) -> DataFrame:
    """Walk a snowflake chain: each level is (dimension, join columns, columns to take)."""
    for dim, on, take in levels:
        df = attach(df, dim, on, take)
    return df
