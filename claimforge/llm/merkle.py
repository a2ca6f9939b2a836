"""A Merkle manifest of a dataset: digests of rows, a tree for each group, one tree over the groups.

Rows are ranked in their group; the base-16 digits of a rank say where its leaf stands
in the tree. Inside blocks of 256 leaves the digits are grouped away one after another, each
step nesting the structs of the step before under its digest. Block digests are the
leaves of the next round until each group is one block. Going down again, a block's own path
is attached to it, and one transform and explode of its nested structs emit the paths of all its
leaves; nothing is joined leaf by leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimforge.session import materialize

FAN = 16
LEVELS = 2  # of the tree inside a block
BLOCK = FAN**LEVELS
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NO_PATH = "array<struct<at:int,run:array<string>>>"


def digest_of(*values: Column) -> Column:
    """SHA-256 as lowercase hex of the values' lengths in bytes and texts; null is told from empty."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings on the path, level by level, left to right."""
    others = F.transform(path, lambda p: F.filter(p["run"], lambda _, i: i != p["at"]))
    return F.sha2(F.concat_ws("", F.flatten(others)), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and its path."""

    def up(below: Column, p: Column) -> Column:
        run = F.transform(p["run"], lambda x, i: F.when(i == p["at"], below).otherwise(x))
        return F.sha2(F.concat_ws("", run), 256)

    return F.aggregate(path, digest, up)


def _ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rank`` of each row in its ``group`` from 0 and ``n``, the group's rows, without a window over a group.

    Rows are parted by ranges of (group, order), so that a large group is many parts; ranks
    come from places inside a part and the sizes of the group's parts before it.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["group", *order]
    placed = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("pos", F.monotonically_increasing_id())
    placed = materialize(placed, name).withColumn("part", F.shiftright("pos", 33))
    runs = placed.groupBy("group", "part").agg(F.count("*").alias("size"), F.min("pos").alias("first"))
    group = Window.partitionBy("group")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("group").alias("g"), F.col("part").alias("p"), F.sum("size").over(group).alias("n"),
        (F.coalesce(F.sum("size").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
    )
    joined = placed.join(runs, (F.col("group") == F.col("g")) & (F.col("part") == F.col("p")))
    return joined.withColumn("rank", F.col("pos") + F.col("shift")).drop("pos", "part", "g", "p", "shift")


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """A stored row for each block: ``group, n, block, digest`` and ``kids``, the nested structs of its nodes.

    ``nodes``: ``group, n, rank, digest, own`` (a struct). A level of the tree that a
    group does not reach, since one node was left before, hands its only node on.
    """
    digits = [f"digit{j}" for j in range(LEVELS)]
    made = [(F.shiftright("rank", 4 * j) % FAN).cast("int").alias(d) for j, d in enumerate(digits)]
    rows = nodes.select("group", "n", F.shiftright("rank", 4 * LEVELS).alias("block"), *made, "digest", "own").repartition("group", "block")
    for j, digit in enumerate(digits):
        kid = F.struct(F.col(digit).alias("at"), "digest", "kids" if j else "own")
        rows = rows.groupBy("group", "n", "block", *digits[j + 1 :]).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
        joint = F.sha2(F.concat_ws("", F.col("kids.digest")), 256)
        rows = rows.withColumn("digest", F.when(F.col("n") > FAN**j, joint).otherwise(F.col("kids")[0]["digest"]))
    return materialize(rows, name)


def _up(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The block tables of each round, the last with one block for each group."""
    rounds = [_blocks(nodes, name)]
    while not rounds[-1].where(F.col("n") > BLOCK).isEmpty():
        last = rounds[-1]
        fewer = F.ceil(F.col("n") / BLOCK).cast("long")
        above = last.select("group", fewer.alias("n"), F.col("block").alias("rank"), "digest", F.struct("block").alias("own"))
        rounds.append(_blocks(above, name))
    return rounds


def _down(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``own, group, path`` and the other columns of ``tops`` (by ``group``, with its ``path``) for each node of the first round."""

    def paths(kids: Column, path: Column, level: int) -> Column:
        def one(kid: Column) -> Column:
            step = F.array(F.struct(kid["at"].alias("at"), kids["digest"].alias("run")))
            mine = F.concat(F.when(F.col("n") > FAN**level, step).otherwise(F.array().cast(_NO_PATH)), path)
            return paths(kid["kids"], mine, level - 1) if level else F.struct(kid["own"].alias("own"), mine.alias("path"))

        made = F.transform(kids, one)
        return F.flatten(made) if level else made

    kept = [c for c in tops.columns if c not in ("group", "path")]
    found, keys = tops, ["group"]
    for blocks in reversed(rounds):
        emitted = F.explode(paths(F.col("kids"), F.col("path"), LEVELS - 1)).alias("e")
        found = blocks.join(found, keys).select("group", *kept, emitted).select("group", *kept, "e.own", "e.path")
        if blocks is not rounds[0]:
            found = found.withColumn("block", F.col("own.block")).drop("own")
            keys = ["group", "block"]
    return found


def manifest(leaves: DataFrame, id_col: str, group_col: str, leaf_col: str) -> DataFrame:
    """``leaves`` with ``subroot, root`` and ``path``: of each level, from the leaf up, the place in the run and all digests of the run.

    Per group leaves ascend by id (null first), then digest; every 16 consecutive ones, the last run
    with fewer, become their joint digest while there are several. Subroots, by group (null first, bytewise),
    likewise make the root. A level with one node only has no step in the path. Any types of
    id and group that have an order and a text will do; other columns of ``leaves`` come along, but for the three new names.
    No rows make no manifest.
    """
    g = F.when(F.col(group_col).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(group_col).cast("string")))
    rows = leaves.select(g.alias("group"), F.col(id_col).alias("id"), F.col(leaf_col).alias("digest"), F.struct("*").alias("own"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")  # row: equal leaves are parted too
    own = _up(_ranked(rows, ["id", "digest", "row"], "ranked"), "blocks")
    subroots = own[-1].select(F.lit("").alias("group"), F.col("group").alias("its"), F.col("digest"))
    ranked = _ranked(subroots, ["its"], "groups").select("group", "n", "rank", "digest", F.struct("its", "digest").alias("own"))
    over = _up(ranked, "group-blocks")
    top = over[-1].select("group", F.col("digest").alias("root"), F.array().cast(_NO_PATH).alias("path"))
    groups = _down(over, top).select(F.col("own.its").alias("group"), F.col("own.digest").alias("subroot"), "root", "path")
    found = _down(own, materialize(groups, "group-paths"))
    return found.select("own.*", "subroot", "root", "path")


def tampered_leaves(docs: DataFrame, id_col: str, columns: list[str], text_col: str, every: int) -> DataFrame:
    """``id, source_key, leaf, tampered``: the digest of each row, and of the row with A-Z of its text in lower case.

    ``tampered`` is null where ``every`` does not divide the CRC-32 of the id's decimal text, and for null ids.
    """
    folded = F.translate(F.col(text_col), _UPPER, _UPPER.lower())
    chosen = F.crc32(F.col(id_col).cast("string")) % every == 0
    other = digest_of(*[folded if c == text_col else F.col(c) for c in columns])
    return docs.select(F.col(id_col).alias("id"), F.col("source").alias("source_key"), digest_of(*map(F.col, columns)).alias("leaf"), F.when(chosen, other).alias("tampered"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of each document, and whether its leaf still folds to the root after some texts were lower-cased."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    leaves = tampered_leaves(docs, "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], "text", 5)
    rows = manifest(leaves, "id", "source_key", "leaf")
    rows = rows.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _sql(levels: int = 6, group_levels: int = 3) -> str:
    """Trees of up to 16**levels leaves, level by level, with the digests left and right of each node in its run."""

    def tree(name: str, depth: int) -> str:
        parts = []
        for k in range(depth):
            parts.append(f"""
{name}l{k} AS (SELECT *,
  CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') OVER (PARTITION BY g, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS lhs,
  CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') OVER (PARTITION BY g, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS rhs
  FROM {name}{k}),
{name}{k + 1} AS (
  SELECT g, i // 16 AS i, (max(n) + 15) // 16 AS n, CASE WHEN max(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY i)) ELSE min(digest) END AS digest
  FROM {name}{k} GROUP BY g, i // 16),""")
        return "".join(parts)

    fields = lambda text: " || ".join(
        f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)
    )
    steps, proof, at = [], [], "a0"
    for k in range(levels):
        steps.append(f"LEFT JOIN tl{k} ON tl{k}.g = a.g AND tl{k}.i = a.i // {16**k}")
        proof.append(f"coalesce(tl{k}.lhs || tl{k}.rhs, '')")
    for k in range(group_levels):
        steps.append(f"LEFT JOIN ul{k} ON ul{k}.i = s.r // {16**k}")
        proof.append(f"coalesce(ul{k}.lhs || ul{k}.rhs, '')")
    folds, at = [], "start"
    for name, depth in (("tl", levels), ("ul", group_levels)):
        for k in range(depth):
            folds.append(f"CASE WHEN {name}{k}_l IS NULL THEN {at} ELSE sha256({name}{k}_l || {at} || {name}{k}_r) END AS {name}{k}_f")
            at = f"{name}{k}_f"
    sides = ", ".join(f"{n}{k}.lhs AS {n}{k}_l, {n}{k}.rhs AS {n}{k}_r" for n, d in (("tl", levels), ("ul", group_levels)) for k in range(d))
    nested = "p"
    for f in folds:
        nested = f"(SELECT *, {f} FROM {nested})"
    return f"""
WITH tab AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM range(256) r(i))),
d AS (
  SELECT *, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS g, sha256({fields("text")}) AS leaf,
    sha256({fields(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")}) AS other,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 5 = 0 AS chosen
  FROM documents, tab),
a AS (
  SELECT doc_id, g, leaf, CASE WHEN chosen THEN other ELSE leaf END AS start, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY g) AS n FROM d),
t0 AS (SELECT g, i, n, leaf AS digest FROM a),{tree("t", levels)}
s AS (SELECT g, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS r, count(*) OVER () AS n FROM t{levels}),
u0 AS (SELECT '' AS g, r AS i, n, subroot AS digest FROM s),{tree("u", group_levels)}
p AS (
  SELECT doc_id, leaf, start, subroot, (SELECT digest FROM u{group_levels}) AS root, sha256({" || ".join(proof)}) AS proof_sha256, {sides}
  FROM a JOIN s ON s.g = a.g {" ".join(steps)})
SELECT doc_id, leaf, subroot, root, proof_sha256, {at} AS folded_root, {at} = root AS verified FROM {nested}
"""


OP13_SQL = _sql()
