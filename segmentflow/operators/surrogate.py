"""Surrogate ids for new contacts (``surrogate_id``).

The reference draws 15 random letters and digits in a Python UDF and
checks them against a list collected to the driver.  Here the id is a
built-in expression of the key: 15 base-62 characters taken from the
SHA-256 of the key (about 89 bits), so a retried batch gives the same id
and no Python runs.  Uniqueness is then checked with an aggregation, and
only colliding new keys are re-hashed with a salt; existing ids never
change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The id alphabet of the reference (upper case, lower case,
# digits, in this order) and the id length.
ID_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
ID_LENGTH = 15


# Characters that each of the two 60-bit numbers read from the digest can
# give, 6 bits per character.
_DIGITS = (10, 10)
MAX_LENGTH = sum(_DIGITS)


def hash_id(key: Column, salt: Column | int | None = None, length: int = ID_LENGTH) -> Column:
    """``length`` base-62 characters from SHA-256 of the key text.

    Hex digits 1-15 and 16-30 of the digest are read as two 60-bit integers;
    character ``j`` of each is ``ALPHABET[((n >> 6j) & 63) mod 62]``, up to
    10 from the first number, the rest from the second (15 characters are
    about 89 bits).  A length over ``MAX_LENGTH`` is an error.  Bit
    operations only, so the digest is converted twice per row rather than
    once per character.  ``salt`` > 0 hashes ``key || '#' || salt``.
    """
    if not 1 <= length <= MAX_LENGTH:
        raise ValueError(f"an id has 1 to {MAX_LENGTH} characters, not {length}")
    text = key.cast("string")
    if salt is not None:
        salt_col = F.lit(salt) if isinstance(salt, int) else salt
        text = F.when(salt_col > 0, F.concat_ws("#", text, salt_col.cast("string"))).otherwise(text)
    digest = F.sha2(text, 256)
    numbers = [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("bigint") for i in range(2)]
    alphabet = F.lit(ID_ALPHABET)
    chars = []
    for number, count in zip(numbers, _DIGITS):
        for j in range(count):
            if len(chars) == length:
                break
            digit = F.pmod(F.shiftright(number, 6 * j).bitwiseAND(F.lit(63)), F.lit(62)).cast("int")
            chars.append(F.substr(alphabet, digit + 1, F.lit(1)))
    # A NULL key gives a NULL digest and so a NULL id.
    return F.concat(*chars)


def hash_id_sql(key_sql: str, length: int = ID_LENGTH) -> str:
    """The same id as DuckDB SQL text, for the oracle."""
    h = f"sha256(CAST({key_sql} AS VARCHAR))"
    numbers = [f"('0x' || substr({h}, {1 + 15 * i}, 15))::BIGINT" for i in range(2)]
    parts = []
    for number, count in zip(numbers, _DIGITS):
        for j in range(count):
            if len(parts) == length:
                break
            parts.append(f"substr('{ID_ALPHABET}', CAST((({number} >> {6 * j}) & 63) % 62 AS INTEGER) + 1, 1)")
    return "(" + " || ".join(parts) + ")"


def fix_collisions(
    state: DataFrame,
    key: str,
    id_col: str,
    keep_keys: DataFrame | None = None,
    length: int = ID_LENGTH,
    check_ids: DataFrame | None = None,
) -> DataFrame:
    """Make ``id_col`` unique in ``state``.

    Keys that already held their id (``keep_keys``: the key column of the
    prior state) keep it; among new keys sharing an id, all but the
    smallest key are re-hashed with the next salt.  The loop runs until no
    id is shared, so nothing is capped; with 89-bit ids it almost never
    runs a second round.

    ``check_ids`` limits the check to ids a batch can have created (for a
    micro-batch: ``hash_id`` of its keys).  The state is then only
    semi-joined to that batch-sized set, not aggregated as a whole; later
    rounds probe only the re-hashed ids.
    """
    salt = 0
    out = state
    spark = state.sparkSession
    # Rows of one key always hash alike, so they could never be told apart.
    if not state.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"{key} is not unique, ids can't be made unique")
    if keep_keys is None:
        keep_keys = spark.createDataFrame([], state.select(key).schema)
    kept = keep_keys.select(F.col(key).alias("_kept")).distinct()
    probe = check_ids
    while True:
        scope = out if probe is None else out.join(probe.select(id_col).distinct(), id_col, "left_semi")
        dup = scope.groupBy(id_col).agg(F.count("*").alias("_n")).filter("_n > 1").select(id_col)
        if dup.isEmpty():
            return out
        salt += 1
        # Only rows holding a shared id take part in the ranking; the rest
        # of the state is joined back by key.
        clash = (
            out.select(key, id_col)
            .join(dup, id_col)
            .join(kept, F.col(key) == F.col("_kept"), "left")
            .withColumn(
                "_rank",
                F.row_number().over(
                    Window.partitionBy(id_col).orderBy(F.col("_kept").isNull(), F.col(key))
                ),
            )
            .filter(F.col("_kept").isNull() & (F.col("_rank") > 1))
            .select(F.col(key).alias("_rekey"))
            .checkpoint()
        )
        out = (
            out.join(clash, F.col(key) == F.col("_rekey"), "left")
            .withColumn(
                id_col,
                F.when(F.col("_rekey").isNotNull(), hash_id(F.col(key), salt, length)).otherwise(
                    F.col(id_col)
                ),
            )
            .select(*state.columns)
            .checkpoint()
        )
        probe = clash.select(hash_id(F.col("_rekey"), salt, length).alias(id_col))


def assign_new_ids(
    new_keys: DataFrame,
    taken_ids: DataFrame,
    key: str,
    id_col: str,
    length: int = ID_LENGTH,
) -> DataFrame:
    """Ids for keys that have none yet: ``(key, id_col)`` per new key,
    unique among themselves and against ``taken_ids`` (the id column of the
    current table).

    Runs before a merge, so the merge itself is evaluated once.  The
    existing ids are only probed: their column is semi-joined to the
    batch-sized candidate set (broadcast when small), never aggregated.
    Colliding keys are re-hashed with the next salt until no clash is left;
    the smallest key keeps a shared candidate id.
    """

    assigned = new_keys.select(key).distinct().withColumn(id_col, hash_id(F.col(key), length=length)).checkpoint()
    taken = taken_ids.select(id_col)
    salt = 0
    while True:
        hit = taken.join(assigned.select(id_col), id_col, "left_semi")
        with_existing = assigned.join(hit, id_col, "left_semi").select(key)
        among_new = (
            assigned.withColumn("_r", F.row_number().over(Window.partitionBy(id_col).orderBy(key)))
            .filter(F.col("_r") > 1)
            .select(key)
        )
        clash = with_existing.union(among_new).distinct().withColumn("_clash", F.lit(True)).checkpoint()
        if clash.isEmpty():
            return assigned
        salt += 1
        assigned = (
            assigned.join(clash, key, "left")
            .withColumn(
                id_col,
                F.when(F.col("_clash"), hash_id(F.col(key), salt, length)).otherwise(F.col(id_col)),
            )
            .select(key, id_col)
            .checkpoint()
        )
