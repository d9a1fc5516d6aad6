"""A Merkle manifest of a dataset, and for each row the proof that it is in it, by paths of parents' preimages.

A leaf is the hash of a row's fields. Leaves of one group stand by ascending id;
while a group has several nodes, every two consecutive ones (the last run may be
one) become the hash of their digests' text. The groups' roots, by group, give the
root in the same way.

What is kept of a parent is its preimage: the concatenated hashes of its
children. Four levels at a time are built from blocks of sixteen nodes, a row a
block, so each table has a sixteenth of the rows of the one below. A leaf's path
is the list of its ancestors' preimages, each with the slot of the leaf's side in it:
joins, from the top down, hand every block what lies above it, and the leaf picks
its own out of its block. Siblings are the preimage without the 64 characters of
the own slot; another leaf folds to another root with its digest spliced in there.

Places within a group come from a range sort and a scan of counts, so a group of
any size is spread over many tasks.

Nulls are a field's ``-``; a null group stands first, as do null ids. Rows of one
group with one id stand by their hashes; repeated rows are leaves of their own. An
empty table gives an empty result. Only the fields' columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import CRC32_TABLE, crc32_sql, cut, temporary
from talkgrain.llm.scan import ranked

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that a block of nodes spans.
_LEVELS = 4


def leaf_hash(values: list[Column]) -> Column:
    """Hash of the values, each ``-`` if null, else its length in bytes, a colon and itself."""
    told = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*told).cast("binary"), 256)


def one_more(number: Column) -> Column:
    """A whole number's text, one higher, whatever the number's type holds."""
    return (number.cast("decimal(20,0)") + 1).cast("string")


def _levels(n: Column) -> Column:
    """How often ``n`` nodes are halved, rounding up, until one is left."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1)))


def build(nodes: DataFrame, counts: DataFrame, most: int) -> list[DataFrame]:
    """The blocks of the trees over ``nodes(tree, pos, hash)``; ``counts(tree, n)``, at most ``most``.

    A table for every four levels: ``tree, block, pre, top``; ``pre`` has for each level within the
    block the preimages of its parents, ``top`` is the node that stands for the block above.
    """
    steps: list[DataFrame] = []
    left = counts.select("tree", _levels(F.col("n")).alias("_left"))
    while True:
        done = _LEVELS * len(steps)
        block = F.shiftright("pos", _LEVELS)
        rows = nodes.groupBy("tree", block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "hash"))).alias("_n")).join(left, "tree")
        rows = rows.select("tree", "block", (F.col("_left") - done).alias("_left"), F.transform("_n", lambda n: n["hash"]).alias("_h"))
        for k in range(1, _LEVELS + 1):
            pairs = F.expr(f"if(_left >= {k}, transform(sequence(0, (size(_h) - 1) div 2), i -> concat(_h[2 * i], coalesce(get(_h, 2 * i + 1), ''))), cast(array() as array<string>))")
            rows = rows.withColumn(f"_p{k}", pairs)
            rows = rows.withColumn("_h", F.expr(f"if(_left >= {k}, transform(_p{k}, p -> sha2(p, 256)), _h)"))
        steps.append(cut(rows.select("tree", "block", F.array(*[f"_p{k}" for k in range(1, _LEVELS + 1)]).alias("pre"), F.col("_h")[0].alias("top")), name="blocks"))
        most = -(-most // 2**_LEVELS)
        if most <= 1:
            return steps
        nodes = steps[-1].select("tree", F.col("block").alias("pos"), F.col("top").alias("hash"))


#: The way from a node at ``_o`` in its block up to the block's top.
_OWN = "transform(filter(pre, p -> size(p) > 0), (p, k) -> struct(shiftright(_o, k) & 1 AS slot, p[shiftright(_o, k + 1)] AS preimage))"


def paths(leaves: DataFrame, steps: list[DataFrame], above: DataFrame) -> DataFrame:
    """``leaves(tree, pos, ...)`` with ``path``, and what else ``above(tree, path, ...)`` says of their tree; its path goes on from a tree's top."""
    more = [c for c in above.columns if c not in ("tree", "path")]
    upper = above.select("tree", F.lit(0).cast("bigint").alias("_b"), F.col("path").alias("_above"), *more)
    offset = lambda c: F.expr(f"cast({c} & {2**_LEVELS - 1} as int)")
    for step, below in zip(reversed(steps[1:]), reversed(steps[:-1]), strict=True):
        here = step.select("tree", F.col("block").alias("_b"), "pre").join(upper, ["tree", "_b"])
        down = below.select("tree", F.col("block").alias("_at"), F.shiftright("block", _LEVELS).alias("_b")).join(here, ["tree", "_b"]).withColumn("_o", offset("_at"))
        upper = down.select("tree", F.col("_at").alias("_b"), F.concat(F.expr(_OWN), F.col("_above")).alias("_above"), *more)
    here = steps[0].select("tree", F.col("block").alias("_b"), "pre").join(upper, ["tree", "_b"])
    rows = leaves.withColumn("_b", F.shiftright("pos", _LEVELS)).join(here, ["tree", "_b"]).withColumn("_o", offset("pos"))
    return rows.select(*leaves.columns, F.concat(F.expr(_OWN), F.col("_above")).alias("path"), *more)


def siblings(path: str = "path") -> Column:
    """The digests beside a path, from the leaf up and from left to right: each preimage without the path's own slot."""
    return F.expr(f"array_join(transform({path}, p -> concat(substring(p.preimage, 1, p.slot * 64), substring(p.preimage, p.slot * 64 + 65))), '')")


def folded(leaf: str, path: str = "path") -> Column:
    """The root that a leaf leads to, with its digest spliced into each preimage of the path."""
    return F.expr(f"aggregate({path}, {leaf}, (h, p) -> sha2(concat(substring(p.preimage, 1, p.slot * 64), h, substring(p.preimage, p.slot * 64 + 65)), 256))")


def manifest(leaves: DataFrame) -> DataFrame:
    """``leaves(id, group, leaf, ...)`` with ``subroot``, ``root`` and ``path``, the preimages from a leaf's parent to the root."""
    with temporary():
        # Groups by UTF-8 bytes, null before all others.
        named = leaves.select("*", F.coalesce(F.concat(F.lit("s"), F.col("group").cast("string")), F.lit("")).alias("tree"))
        kept = cut(named, name="leaves")
        placed = cut(ranked(kept, ["tree"], ["id", "leaf"], kept.count()), name="ranked")
        counts = cut(placed.groupBy("tree").agg(F.count("*").alias("n")), name="counts")
        groups, most = counts.agg(F.count("*"), F.max("n")).first()
        steps = build(placed.select("tree", "pos", F.col("leaf").alias("hash")), counts, most or 1)
        tops = steps[-1].select(F.col("tree").alias("name"), F.col("top").alias("hash"))
        tops = ranked(tops.withColumn("tree", F.lit("")), ["tree"], ["name"], groups)
        tops = cut(tops, name="subroots")
        upper = build(tops.select("tree", "pos", "hash"), tops.groupBy("tree").agg(F.count("*").alias("n")), groups or 1)
        nothing = F.expr("cast(array() as array<struct<slot: int, preimage: string>>)")
        above = paths(tops, upper, upper[-1].select("tree", nothing.alias("path"), F.col("top").alias("root")))
        above = above.select(F.col("name").alias("tree"), "path", F.col("hash").alias("subroot"), "root")
        return cut(paths(placed, steps, above).select(*leaves.columns, "subroot", "root", "path"), name="manifest", keep=True)


def document_leaves(docs: DataFrame) -> DataFrame:
    """Documents as leaves; ``changed`` is the leaf of those that were tampered with, else the leaf."""
    fields = [F.col(c) for c in FIELDS]
    wrong = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    other = leaf_hash([one_more(v) if c == "n_chars" else v for c, v in zip(FIELDS, fields, strict=True)])
    rows = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("group"), leaf_hash(fields).alias("leaf"), F.when(wrong, other).alias("_other"))
    return rows.select("id", "group", "leaf", F.coalesce("_other", "leaf").alias("changed"))


def digest(found: DataFrame) -> DataFrame:
    """What a manifest says of every row, and whether the row as it is now leads to the manifest's root."""
    rows = found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(), 256).alias("proof_sha256"), folded("changed").alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


#: For the fields of documents.
ORACLE_SQL = f"""
WITH RECURSIVE {CRC32_TABLE},
d AS (SELECT doc_id, source, lang, n_chars, text, {crc32_sql("doc_id::VARCHAR")} % 7 = 0 AS wrong FROM documents, crc),
f AS (SELECT doc_id, lang, wrong, COALESCE(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || COALESCE(strlen(source) || ':' || source, '-') || COALESCE(strlen(lang) || ':' || lang, '-') AS head, n_chars, COALESCE(strlen(text) || ':' || text, '-') AS tail FROM d),
l AS (SELECT doc_id, lang, sha256(head || COALESCE(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf, CASE WHEN wrong THEN sha256(head || COALESCE(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS other FROM f),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
n AS (SELECT COALESCE('s' || lang, '') AS tree, 0 AS level, pos, leaf AS hash, count(*) OVER (PARTITION BY lang) AS size FROM p
  UNION ALL SELECT tree, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), any_value((size + 1) // 2) FROM n WHERE size > 1 GROUP BY tree, level, pos // 2),
s AS (SELECT tree, hash, row_number() OVER (ORDER BY tree) - 1 AS pos FROM n WHERE size = 1),
u AS (SELECT 0 AS level, pos, hash, count(*) OVER () AS size FROM s UNION ALL SELECT level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), any_value((size + 1) // 2) FROM u WHERE size > 1 GROUP BY level, pos // 2),
h AS (SELECT p.doc_id, p.leaf, COALESCE(p.other, p.leaf) AS now, s.tree, s.pos AS place, s.hash AS subroot, p.pos FROM p JOIN s ON s.tree = COALESCE('s' || p.lang, '')),
w AS (SELECT h.*, 0 AS level, false AS up, now AS folded, '' AS beside, (SELECT max(level) FROM n WHERE n.tree = h.tree) AS top FROM h
  UNION ALL SELECT w.doc_id, w.leaf, w.now, w.tree, w.place, w.subroot, w.pos // 2, w.level + 1, false,
    CASE WHEN n.hash IS NULL THEN sha256(w.folded) WHEN w.pos % 2 = 0 THEN sha256(w.folded || n.hash) ELSE sha256(n.hash || w.folded) END, w.beside || COALESCE(n.hash, ''), w.top
  FROM w LEFT JOIN n ON n.tree = w.tree AND n.level = w.level AND n.pos = xor(w.pos, 1) WHERE w.level < w.top),
v AS (SELECT doc_id, leaf, subroot, 0 AS level, place AS pos, folded, beside FROM w WHERE level = top
  UNION ALL SELECT v.doc_id, v.leaf, v.subroot, v.level + 1, v.pos // 2, CASE WHEN u.hash IS NULL THEN sha256(v.folded) WHEN v.pos % 2 = 0 THEN sha256(v.folded || u.hash) ELSE sha256(u.hash || v.folded) END, v.beside || COALESCE(u.hash, '')
  FROM v LEFT JOIN u ON u.level = v.level AND u.pos = xor(v.pos, 1) WHERE v.level < (SELECT max(level) FROM u))
SELECT doc_id, leaf, subroot, root, sha256(beside) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM v, (SELECT hash AS root FROM u WHERE size = 1) WHERE level = (SELECT max(level) FROM u)
"""
