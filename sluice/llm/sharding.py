"""Sharding by a hierarchical weighted hash tree [native].

The cluster is a tree region -> rack -> shard.  A row descends it: at every
level each child of the node reached so far draws ``-ln(u) / weight`` with
``u`` hashed from the row's key and the child's name, and the smallest draw
wins.  An inner node weighs what its shards weigh together.  A draw depends
only on the key, the child and the child's weight, so a change of weight moves
rows only into or out of the children whose weight changed, level by level:
every other subtree keeps its rows and their places.  ``grow`` attaches new
capacity as a subtree of its own, so rows move into the new shard only.

Slots number the rows of a shard without gaps.  They need no global sort: rows
of a shard are dealt into hash buckets, bucket counts give each bucket's first
slot, and a window numbers the rows of one bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hex digits of a draw: 52 bits, exact in a double.
DRAW_HEX = 13
#: Hex digits of the slot bucket: 16**3 buckets a shard.
BUCKET_HEX = 3


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int, per_rack: int = 4, racks_per_region: int = 3) -> list[Shard]:
    """Shards 0..n-1, filled rack by rack and region by region, of equal weight."""
    return [Shard(s // (per_rack * racks_per_region), s // per_rack, s) for s in range(shards)]


def grow(nodes: list[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard, in a rack and a region of its own."""
    return [*nodes, Shard(*(1 + max(getattr(n, f) for n in nodes) for f in ("region", "rack", "shard")), weight)]


def levels(nodes: list[Shard]) -> list[dict[int, list[tuple[str, int, float]]]]:
    """For each level: parent -> its children as (name, id, weight)."""
    out: list[dict[int, list[tuple[str, int, float]]]] = []
    for letter, parent, child in (("g", None, "region"), ("k", "region", "rack"), ("s", "rack", "shard")):
        weights: dict[tuple[int, int], float] = {}
        for n in nodes:
            at = (getattr(n, parent) if parent else 0, getattr(n, child))
            weights[at] = weights.get(at, 0.0) + n.weight
        level: dict[int, list[tuple[str, int, float]]] = {}
        for (up, own), w in sorted(weights.items()):
            level.setdefault(up, []).append((f"{letter}{own}", own, w))
        out.append(level)
    return out


def _draw(key: Column, child: Column) -> Column:
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), child["name"])), 1, DRAW_HEX), 16, 10)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(16 ** DRAW_HEX))) / child["weight"]


def _child(name: str, own: int, weight: float) -> Column:
    return F.struct(F.lit(name).alias("name"), F.lit(own).alias("id"), F.lit(weight).alias("weight"))


def place(key: Column, nodes: list[Shard]) -> Column:
    """The shard of a key (string column).  The tree is a literal of the plan: its size is the cluster's."""
    at = F.lit(0)
    for level in levels(nodes):
        children = F.element_at(F.create_map(*[x for up, kids in level.items() for x in
                                               (F.lit(up), F.array(*[_child(*k) for k in kids]))]), at)
        at = F.array_min(F.transform(children, lambda c: F.struct(_draw(key, c).alias("draw"),
                                                                  c["id"].alias("id"))))["id"]
    return at


def key_of(id_column: Column) -> Column:
    return F.coalesce(id_column.cast("string"), F.lit("null"))


def shard_rows(df: DataFrame, nodes: list[Shard], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``df`` once: id, ``size`` (UTF-8 bytes + 8), ``text_crc32``, ``shard``, ``slot`` and
    ``grown_shard`` (with one more shard).

    Null text counts as empty; a null id has the key ``null``.  Rows that repeat an id share its shard and
    take slots of their own; wholly equal rows are interchangeable there.  Other columns of ``df`` are not
    read, so their names cannot clash.  An empty table gives no rows.
    """
    key = key_of(F.col(id_col))
    bucket = F.substring(F.md5(F.concat(key, F.lit(":slot"))), 1, BUCKET_HEX)
    # The first slots need ids only, so this scan does not read the texts.
    counts = (df.select(place(key, nodes).alias("shard"), bucket.alias("bucket"))
              .groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
                     F.crc32(text).alias("text_crc32"), place(key, nodes).alias("shard"), bucket.alias("bucket"),
                     place(key, grow(nodes)).alias("grown_shard"))
    own = Window.partitionBy("shard", "bucket").orderBy("id", "text_crc32", "size")
    numbered = rows.withColumn("own", F.row_number().over(own) - 1)
    # At most shards * 16**BUCKET_HEX rows of a few bytes: bounded by the cluster, not by the data.
    placed = numbered.join(F.broadcast(first), ["shard", "bucket"])
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", "shard",
                         (F.col("first") + F.col("own")).alias("slot"), "grown_shard")


def oracle_sql(nodes: list[Shard]) -> str:
    """DuckDB SQL for the ``key`` law over ``documents``."""
    def values(ns: list[Shard], level: int) -> str:
        return ", ".join(f"({up}, '{name}', {own}, {w})" for up, kids in levels(ns)[level].items()
                         for name, own, w in kids)

    def descend(ns: list[Shard], tag: str) -> str:
        up, ctes = "keyed", []
        for level in range(3):
            at = "0" if level == 0 else "d.at"
            ctes.append(f"""{tag}{level} AS (SELECT d.rid, arg_min(c.own, (-ln((('0x' || substr(md5(d.k || ':' || c.name), 1, {DRAW_HEX}))::UBIGINT + 0.5) / {16 ** DRAW_HEX}.0) / c.w)) AS at, any_value(d.k) AS k
                FROM {up} d JOIN (VALUES {values(ns, level)}) c(up, name, own, w) ON c.up = {at} GROUP BY d.rid)""")
            up = f"{tag}{level}"
        return ", ".join(ctes)

    # CRC-32 is linear: it is the xor of what each set bit gives, by the bit and its distance from the text's
    # end (columns b0..b7), and of what the start value gives by the length (column s).
    table = f"([{', '.join(str(_crc_entry(i)) for i in range(256))}]::UBIGINT[])"
    start = ", ".join(f"{_crc_entry(1 << b)}::UBIGINT AS b{b}" for b in range(8))
    step = ", ".join(f"xor({c} >> 8, {table}[(({c} & 255) + 1)::BIGINT])" for c in ["s", *[f"b{b}" for b in range(8)]])
    given = "0::UBIGINT"
    for b in range(8):
        given = f"xor({given}, ((v >> {b}) & 1) * b{b})"
    return f"""WITH RECURSIVE keyed AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(doc_id::VARCHAR, 'null') AS k FROM documents),
        bytes AS (SELECT rid, hex(encode(text)) AS h, strlen(text) AS n FROM keyed),
        far AS (SELECT 0::BIGINT AS d, 4294967295::UBIGINT AS s, {start}
            UNION ALL SELECT d + 1, {step} FROM far WHERE d < (SELECT max(n) FROM bytes)),
        single AS (SELECT rid, n, unnest(range(n)) AS i, unnest(list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::UBIGINT)) AS v FROM bytes),
        given AS (SELECT rid, bit_xor({given}) AS x FROM single JOIN far ON far.d = n - 1 - i GROUP BY rid),
        crc AS (SELECT bytes.rid, xor(xor(coalesce(x, 0::UBIGINT), far.s), 4294967295::UBIGINT)::BIGINT AS crc
            FROM bytes JOIN far ON far.d = bytes.n LEFT JOIN given ON given.rid = bytes.rid),
        {descend(nodes, "p")}, {descend(grow(nodes), "q")}
        SELECT d.doc_id, (strlen(d.text) + 8)::BIGINT AS size, crc.crc AS text_crc32, 'key' AS law, p2.at::INTEGER AS shard,
            row_number() OVER (PARTITION BY p2.at ORDER BY substr(md5(d.k || ':slot'), 1, {BUCKET_HEX}), d.doc_id NULLS FIRST, crc.crc) - 1 AS slot,
            q2.at::INTEGER AS grown_shard
        FROM keyed d JOIN p2 USING (rid) JOIN q2 USING (rid) JOIN crc USING (rid)"""


def _crc_entry(i: int) -> int:
    for _ in range(8):
        i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
    return i
