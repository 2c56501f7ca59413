"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number in (0, 1) from the record's key and its own name;
the shard with the largest ``-weight / ln(u)`` takes the record. A further
shard changes nothing in the other shards' draws, so records move only into
it. The draws come from md5, which any engine can repeat.

Places in a shard are gapless: ranks by a second hash of the key, found through a sort by ranges of
numbers only. A shard, or a key, with any share of all rows is spread over tasks. Texts are joined to their places by a row
number when there are any to carry.

Defined results: a null key is hashed as the text ``null``; repeated rows share a shard
and get places of their own; null and empty texts have no bytes; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymosaic.llm.tables import hidden, save, table, with_places

SHARDS = 24
_DIGITS = 13
_SPAN = float(16**_DIGITS)


def _draw(text: Column) -> Column:
    """52 bits of the md5 of ``text``."""
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("bigint")


def _key(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("null"))


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard, 0 to ``len(weights) - 1``, that takes ``key``; of equal scores the first."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    draws = [_draw(F.concat(_key(key), F.lit(f":{i}"))) for i in range(len(weights))]
    if len(set(weights)) == 1:  # the order of the scores is then the order of the draws
        scores = draws
    else:
        scores = [F.lit(-float(w)) / F.log((d + F.lit(0.5)) / F.lit(_SPAN)) for d, w in zip(draws, weights)]
    best = F.greatest(*[F.struct(s.alias("score"), F.lit(-i).alias("shard")) for i, s in enumerate(scores)])
    return (-best["shard"]).cast("int")


def place_hash(key: Column) -> Column:
    """Order of the records inside a shard."""
    return _draw(F.concat(_key(key), F.lit(":place")))


def assign(docs: DataFrame, key: str = "doc_id", weights: list[float] | None = None, carry: dict | None = None) -> DataFrame:
    """Columns of ``carry`` (name to an expression of few bytes; the key when None) with ``shard``, ``slot`` and ``grown_shard``.

    ``grown_shard`` is the shard with one more shard of the mean weight. Only the carried columns move, and break
    ties of the hash; they must not be named like those three.
    """
    weights = weights or [1.0] * SHARDS
    carry = {key: F.col(f"`{key}`")} if carry is None else carry
    of = F.col(f"`{key}`")
    shard, drawn = shard_of(of, weights), _draw(F.concat(_key(of), F.lit(f":{len(weights)}")))
    if len(set(weights)) == 1:
        chosen = F.greatest(*[_draw(F.concat(_key(of), F.lit(f":{i}"))) for i in range(len(weights))])
        grown = F.when(drawn > chosen, F.lit(len(weights))).otherwise(shard)
    else:
        grown = shard_of(of, [*weights, sum(weights) / len(weights)])
    names = {name: f"c{k}" for k, name in enumerate(carry)}
    assigned = docs.select(
        *[c.alias(names[name]) for name, c in carry.items()],
        shard.alias("in_shard"), grown.cast("int").alias("grown"), place_hash(of).alias("draw"))
    placed = with_places(assigned, ["in_shard"], ["draw", *names.values()], "shards")
    return placed.select(
        *[F.col(c).alias(name) for name, c in names.items()],
        F.col("in_shard").alias("shard"), F.col("place").alias("slot"), F.col("grown").alias("grown_shard"),
    )


PLACES = ("shard", "slot", "grown_shard")


def sharded_documents(docs: DataFrame, key: str = "doc_id", weights: list[float] | None = None) -> DataFrame:
    """``docs`` with ``shard``, ``slot`` and ``grown_shard``; only ids are ranked, the other columns are joined to their places.

    A column of ``docs`` with one of these names stays as ``given_<name>``, with as many ``given_`` as it takes.
    """
    plain, back = hidden(docs)
    numbered, _ = save(plain.withColumn("row", F.monotonically_increasing_id()), "shard-rows")
    placed = assign(numbered, back[key], weights, {"key": F.col(back[key]), "of_row": F.col("row")}).drop("key")
    used, names = {c.lower() for c in docs.columns} | set(PLACES), []
    for c in docs.columns:
        name = c
        while name.lower() in PLACES or (name != c and name.lower() in used):
            name = f"given_{name}"
        used.add(name.lower())
        names.append(F.col(back[c]).alias(name))
    return numbered.join(placed, F.col("row") == F.col("of_row")).select(*names, *PLACES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = assign(table(spark, sf_dir, "documents"), carry={
        "doc_id": F.col("doc_id"),
        "size": (F.octet_length(text) + 8).cast("bigint"),
        "text_crc32": F.crc32(text.cast("binary")),
    })
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def _sql_draw(suffix: str) -> str:
    return f"CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':{suffix}'), 1, {_DIGITS}) AS BIGINT)"


def _sql() -> str:
    draws = ", ".join(f"{{'s': {_sql_draw(i)}, 'k': {-i}}}" for i in range(SHARDS))
    return f"""
WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b, list_max([{draws}]) AS best, {_sql_draw(SHARDS)} AS next,
        {_sql_draw("place")} AS place FROM documents),
 crc_table AS (SELECT list(list_reduce(list_prepend(n, range(0, 8)), lambda c, i:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS v FROM range(0, 256) AS r(n)),
 s AS (SELECT doc_id, octet_length(b) + 8 AS size, xor(list_reduce(list_prepend(4294967295,
        list_transform(range(1, 2 * octet_length(b), 2), lambda i: CAST('0x' || substr(hex(b), i, 2) AS BIGINT))),
        lambda c, x: xor(c >> 8, v[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32,
    -best.k AS shard, CASE WHEN next > best.s THEN {SHARDS} ELSE -best.k END AS grown_shard, place FROM t, crc_table)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY place, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard
FROM s"""


SQL = _sql()
