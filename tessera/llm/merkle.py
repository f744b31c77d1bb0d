"""Operator 13, Merkle dataset manifest: nested-struct rollup of rank digits within bounded blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.windows import row_number
from .common import staged

BITS = 8             # levels of a block: a block holds 2**BITS nodes

_PATH = "array<struct<left: boolean, h: string>>"
_UP = f"struct<path: {_PATH}, subroot: string, root: string>"


def _hash(*parts):
    return F.sha2(F.concat(*parts), 256)


def _field(col):
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    value = col.cast("string")
    return F.when(col.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaves(docs: DataFrame) -> DataFrame:
    """``t, doc_id, h, start``: tree key of the language (null first), leaf, and the leaf after tampering."""
    names = ("doc_id", "source", "lang", "n_chars", "text")
    doc = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                      F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("decimal(20,0)").alias("n_chars"),
                      F.col("text").cast("string").alias("text"))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    plain = {n: _field(F.col(n)) for n in names}
    other = plain | {"n_chars": _field((F.col("n_chars") + 1).cast("decimal(20,0)"))}
    return (doc.select(F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), "lang")).alias("t"), "doc_id",
                       _hash(*plain.values()).alias("h"),
                       F.when(tampered & F.col("n_chars").isNotNull(), _hash(*other.values())).alias("changed"))
            .select("t", "doc_id", "h", F.coalesce("changed", "h").alias("start")))


def _digits(df: DataFrame, bits: int) -> DataFrame:
    """Rank ``r`` as a block and ``bits`` binary digits, rows of a block in one partition (about shuffle.partitions of them)."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cols = {f"d{k}": F.shiftright("r", k).bitwiseAND(F.lit(1)).cast("int") for k in range(bits)}
    return df.withColumns({"block": F.shiftright("r", bits)} | cols).repartition(n, "t", "block")


def _roll(df: DataFrame, bits: int, nested: bool) -> DataFrame:
    """Group the digits away one by one; a row per block, with its node (children nested if asked for) and ``up``.

    All groupings contain the block, so they run in the partitions that ``_digits`` made, without another exchange.
    A group of one is the whole tree's only node if nothing stands before it; that node stays as it is.
    """
    for k in range(bits):
        rest = ["t", "block"] + [f"d{i}" for i in range(bits - 1, k, -1)]
        kids = F.array_sort(F.collect_list(F.when(F.col("node").isNotNull(), F.struct(F.col(f"d{k}").alias("d"), "node"))))
        df = df.groupBy(*rest).agg(kids.alias("kids"), F.first("up", ignorenulls=True).alias("up"))
        a, b = F.col("kids")[0]["node"], F.get("kids", F.lit(1))["node"]
        alone = (F.size("kids") == 1) & (F.col("block") == 0)
        for d in rest[2:]:
            alone = alone & (F.col(d) == 0)
        h = F.when(alone, a["h"]).when(b["h"].isNull(), _hash(a["h"])).otherwise(_hash(a["h"], b["h"]))
        node = [h.alias("h")]
        if nested:
            node += [alone.alias("alone"), F.transform("kids", lambda x: x["node"]).alias("kids")]
        df = df.select(*rest, F.struct(*node).alias("node"), "up")
    return df


def _block_roots(nodes: DataFrame, bits: int) -> DataFrame:
    """The nodes of the next level: ``t, r, h`` with the block as rank."""
    rows = nodes.select("t", "r", F.struct("h").alias("node"), F.lit(None).cast(_UP).alias("up"))
    return _roll(_digits(rows, bits), bits, nested=False).select("t", F.col("block").alias("r"), F.col("node.h").alias("h"))


def _below(nodes: DataFrame, up: DataFrame, bits: int) -> DataFrame:
    """``nodes`` with the way to the root that ``up (t, r = block, up)`` holds for their blocks.

    The way up travels as one more row of its block; the nested children are then
    unfolded from the top, a sibling put before the way at each level.
    """
    payload = [c for c in nodes.columns if c not in ("t", "r", "h")]
    leaf = F.struct("h", F.struct("r", *payload).alias("p"))
    shift = F.shiftleft("r", bits)
    rows = nodes.select("t", "r", leaf.alias("node"), F.lit(None).cast(_UP).alias("up"))
    kind = rows.schema["node"].dataType
    rows = rows.unionByName(up.select("t", shift.alias("r"), F.lit(None).cast(kind).alias("node"), "up"))
    df = _roll(_digits(rows, bits), bits, nested=True)
    todo = F.array(F.struct("node", F.col("up.path").alias("path")))
    for _ in range(bits):
        def unfold(x):
            def one(kid, i):
                sibling = F.get(x["node"]["kids"], F.lit(1) - i)["h"]
                step = F.array(F.struct((i == 1).alias("left"), sibling.alias("h"))).cast(_PATH)
                return F.struct(kid.alias("node"), F.when(x["node"]["alone"], x["path"])
                                .otherwise(F.concat(step, x["path"])).alias("path"))
            return F.transform(x["node"]["kids"], one)
        todo = F.flatten(F.transform(todo, unfold))
    return (df.select("t", F.col("up.subroot").alias("subroot"), F.col("up.root").alias("root"), F.explode(todo).alias("x"))
            .select("t", F.col("x.node.h").alias("h"), "x.node.p.*", "x.path", "subroot", "root"))


def _climb(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """Levels of block roots, each written, until every tree is one node; the first entry is ``nodes``."""
    levels = [nodes]
    while True:
        levels.append(staged(_block_roots(levels[-1], bits), "merkle-level"))
        if not (levels[-1].agg(F.max("r")).first()[0] or 0):
            return levels


def merkle_manifest(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf is the sha256 of the fields doc_id, source, lang, n_chars and text,
    each ``-`` if null. The leaves of a language ascend by doc_id (null last;
    rows that share a doc_id by leaf, so repeated rows have the same leaf at
    neighbouring places) and pair up level by level to a subroot; the subroots,
    null language first, likewise to the root. Documents whose crc32(doc_id) is
    divisible by 7 are tampered with (n_chars + 1; a null n_chars or doc_id
    leaves them alone) before their proof is folded again. A null text differs
    from an empty one. An empty table gives no rows; other columns, whatever
    their names, are left behind.

    The rank in its language is cut into blocks of ``2**bits`` nodes. A block is
    the largest thing that a task holds at once: its digits are grouped away one
    after the other, and its root is a node of the next, ``2**bits`` times
    smaller level. No level is brought to the driver or joined: going down, the
    way from a block to the root is one more row of that block's first group.
    """
    own = leaves(docs)
    ranked = staged(row_number(own, ["doc_id", "h"], "t", output="n")
                    .select("t", (F.col("n") - 1).alias("r"), "h", "doc_id", "start"), "merkle-leaves")
    trees = _climb(ranked, bits)
    tops = row_number(trees[-1].select(F.col("t").alias("lang"), "h"), ["lang"], output="n")
    tops = staged(tops.select(F.lit("").alias("t"), (F.col("n") - 1).alias("r"), "h", "lang"), "merkle-tops")
    langs = _climb(tops, bits)
    none = F.array().cast(_PATH)
    up = langs[-1].select("t", "r", F.struct(none.alias("path"), F.lit(None).cast("string").alias("subroot"),
                                             F.col("h").alias("root")).cast(_UP).alias("up"))
    for level in reversed(langs[:-1]):
        below = _below(level, up, bits)
        if level is tops:
            up = below.select(F.col("lang").alias("t"), F.lit(0).cast("long").alias("r"),
                              F.struct("path", F.col("h").alias("subroot"), "root").cast(_UP).alias("up"))
        else:
            up = below.select("t", "r", F.struct("path", "subroot", "root").cast(_UP).alias("up"))
        up = staged(up, "merkle-ways")
    for level in reversed(trees[1:-1]):
        up = staged(_below(level, up, bits).select("t", "r", F.struct("path", "subroot", "root").cast(_UP).alias("up")),
                    "merkle-ways")
    out = _below(ranked, up, bits)
    folded = F.aggregate("path", F.col("start"), lambda node, s: F.when(s["h"].isNull(), _hash(node))
                         .when(s["left"], _hash(s["h"], node)).otherwise(_hash(node, s["h"])))
    return (out.select("doc_id", F.col("h").alias("leaf"), "subroot", "root",
                       F.sha2(F.array_join(F.transform("path", lambda s: s["h"]), ""), 256).alias("proof_sha256"),
                       folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


SQL = r"""
WITH RECURSIVE base AS (
  SELECT doc_id, coalesce('=' || lang, '') AS t, source, lang, n_chars, text,
         list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
           lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[]),
             lambda x, k: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))) AS crc
  FROM documents),
field AS (
  SELECT doc_id, t, n_chars, xor(crc, 4294967295::UBIGINT) % 7 = 0 AS hit,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS before,
         coalesce(strlen(text) || ':' || text, '-') AS after
  FROM base),
leaf AS (
  SELECT doc_id, t, sha256(before || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || after) AS h,
         CASE WHEN hit AND n_chars IS NOT NULL
              THEN sha256(before || strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) || after) END AS changed
  FROM field),
ranked AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST, h) - 1 AS r FROM leaf),
tree AS (
  SELECT t, 0 AS level, list(h ORDER BY r) AS nodes FROM ranked GROUP BY t
  UNION ALL
  SELECT t, level + 1, list_transform(range((len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM tree WHERE len(nodes) > 1),
sub AS (SELECT t, nodes[1] AS subroot, row_number() OVER (ORDER BY t) - 1 AS r FROM tree WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS level, list(subroot ORDER BY r) AS nodes FROM sub
  UNION ALL
  SELECT level + 1, list_transform(range((len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM top WHERE len(nodes) > 1),
steps AS (
  SELECT x.t, x.r, tree.level, (x.r >> tree.level) & 1 AS bit, tree.nodes[xor(x.r >> tree.level, 1) + 1] AS sibling
  FROM ranked x JOIN tree ON tree.t = x.t AND len(tree.nodes) > 1
  UNION ALL
  SELECT x.t, x.r, 1000 + top.level, (s.r >> top.level) & 1, top.nodes[xor(s.r >> top.level, 1) + 1]
  FROM ranked x JOIN sub s ON s.t = x.t JOIN top ON len(top.nodes) > 1),
path AS (SELECT t, r, list({'bit': bit, 'h': sibling} ORDER BY level) AS steps FROM steps GROUP BY t, r),
fold AS (
  SELECT x.t, x.r, 1 AS k, coalesce(changed, h) AS node, coalesce(steps, []) AS steps
  FROM ranked x LEFT JOIN path p ON p.t = x.t AND p.r = x.r
  UNION ALL
  SELECT t, r, k + 1, CASE WHEN steps[k].h IS NULL THEN sha256(node) WHEN steps[k].bit = 1 THEN sha256(steps[k].h || node)
                           ELSE sha256(node || steps[k].h) END, steps
  FROM fold WHERE k <= len(steps))
SELECT x.doc_id, x.h AS leaf, s.subroot, top.nodes[1] AS root,
       sha256(coalesce(list_reduce(list_prepend('', list_transform(f.steps, lambda p: coalesce(p.h, ''))), lambda a, b: a || b), '')) AS proof_sha256,
       f.node AS folded_root, f.node = top.nodes[1] AS verified
FROM ranked x JOIN sub s ON s.t = x.t JOIN top ON len(top.nodes) = 1
JOIN fold f ON f.t = x.t AND f.r = x.r AND f.k = len(f.steps) + 1
"""
