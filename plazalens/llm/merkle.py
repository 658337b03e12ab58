"""Merkle manifest of a table: a hash tree per group of rows, one over the groups, and a proof for every row.

Built levels are stored as node rows that name their parent. Proofs come from a recursive query that climbs them: every row of the
recursion is a run of up to eight sibling leaves, which share all of their path above the run, so they climb together; each step appends
the siblings to the shared proof and folds every leaf's own hash, tampered or not, one node up.
"""

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import ascii_lower, need, parked
from plazalens.llm.ranks import numbered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 8
DIGEST = 32
# Node rows up to this many bytes are sent to all tasks of a step of the climb, more are shuffled to
BROADCAST_BYTES = 16 << 20
TOP = ""  # the tree over the groups; the groups' own names begin with = or are -


def _sized(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_hash(fields: list[Column]) -> Column:
    """Digest of a row: each field as its byte count, a colon and its value; a null as a dash."""
    return F.unhex(F.sha2(F.concat(*[_sized(f) for f in fields]), 256))


def hashed(digests: Column) -> Column:
    """Digest of digests, which are taken as lower-case hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)), 256))


def _without(kids: Column, place: Column) -> Column:
    return F.concat(_before(kids, place), _after(kids, place))


def _before(kids: Column, place: Column) -> Column:
    return kids.substr(F.lit(1), place * DIGEST)


def _after(kids: Column, place: Column) -> Column:
    return kids.substr(place * DIGEST + DIGEST + 1, F.length(kids))


def _up(idx: str = "idx") -> Column:
    return F.expr(f"{idx} div {RUN}")


def _level(nodes: DataFrame, level: int) -> DataFrame:
    """The parents of nodes (tree, idx, n, hash) of trees that have several: tree, level, idx, n, kids, hash."""
    kids = F.array_sort(F.collect_list(F.struct("idx", "hash")))
    runs = nodes.where("n > 1").groupBy("tree", _up().alias("up"), F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n")).agg(kids.alias("k"))
    blob = F.aggregate("k.hash", F.lit(b""), lambda a, b: F.concat(a, b))
    rows = runs.select("tree", F.lit(level).alias("level"), F.col("up").alias("idx"), "n", blob.alias("kids"))
    return rows.withColumn("hash", hashed(F.col("kids")))


def _levels(nodes: DataFrame, first: int) -> list[DataFrame]:
    """All levels above ``nodes``, each written."""
    out = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        nodes = parked(_level(nodes, first + len(out)), "nodes")
        out.append(nodes)
        most = -(-most // RUN)
    return out


def _linked(nodes: DataFrame, ranks: DataFrame, several: bool) -> DataFrame:
    """Adds the parent (p_tree, p_level, p_idx, null at the root) and the place among its children (p_pos)."""
    inner = nodes.where(f"n > 1").select(
        "*", F.col("tree").alias("p_tree"), (F.col("level") + 1).alias("p_level"), _up().alias("p_idx"), F.expr(f"idx % {RUN}").alias("p_pos")
    )
    # one row a tree
    roots = nodes.where("n = 1").join(ranks.select(F.col("tree").alias("r_tree"), F.col("idx").alias("rank")), F.col("tree") == F.col("r_tree"), "left")
    up = F.lit(several) & (F.col("tree") != TOP)
    roots = roots.select(
        *nodes.columns, F.when(up, F.lit(TOP)).alias("p_tree"), F.when(up, F.lit(1)).alias("p_level"),
        F.when(up, _up("rank")).alias("p_idx"), F.when(up, F.expr(f"rank % {RUN}")).alias("p_pos"),
    )
    return inner.unionByName(roots)


CLIMB = """
with recursive climb as (
  select tree, ids, kids, folded, proof, p_tree, p_level, p_idx, p_pos from {runs}
  union all
  select {hint} c.tree, c.ids, c.kids,
    transform(c.folded, f -> unhex(sha2(lower(hex(concat(
      substr(n.kids, 1, 32 * c.p_pos), f, substr(n.kids, 32 * c.p_pos + 33)))), 256))),
    concat(c.proof, substr(n.kids, 1, 32 * c.p_pos), substr(n.kids, 32 * c.p_pos + 33)),
    n.p_tree, n.p_level, n.p_idx, n.p_pos
  from climb c join {nodes} n on n.tree = c.p_tree and n.level = c.p_level and n.idx = c.p_idx
)
select tree, ids, kids, folded, proof from climb where p_tree is null
"""


def climbed(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """tree, ids, kids, folded and proof of every run after its climb to the root, written.

    Spark ends a recursion at a number of rows unless told otherwise; the climb ends by itself at the root, so that bound is lifted for it.
    """
    spark = runs.sparkSession
    names = {"runs": f"runs_{uuid.uuid4().hex}", "nodes": f"nodes_{uuid.uuid4().hex}"}
    runs.createOrReplaceTempView(names["runs"])
    nodes.createOrReplaceTempView(names["nodes"])
    size = nodes.agg(F.sum(F.length("kids") + 100)).first()[0] or 0
    hint = "/*+ broadcast(n) */" if size <= BROADCAST_BYTES else ""
    bound = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(bound)
    spark.conf.set(bound, "-1")
    try:
        return parked(spark.sql(CLIMB.format(hint=hint, **names)), "climb")
    finally:
        spark.conf.set(bound, before)
        for name in names.values():
            spark.catalog.dropTempView(name)


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row: its tree is that of its ``lang``.

    ``tampered`` says for which rows the text's A-Z are lower-cased before their path is folded; null means no. Leaves of a tree ascend by
    doc_id, nulls first, rows of one id by their digest; rows that repeat in all fields have a leaf each. Null and missing values differ
    from empty ones. Columns other than FIELDS are not read. An empty table has no root and gives no rows.
    """
    cols = {c: F.col(c) for c in FIELDS}
    whole = row_hash([*cols.values()])
    changed = row_hash([*[cols[c] for c in FIELDS[:-1]], ascii_lower(F.col("text"))])
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))
    leaves = need(docs, *FIELDS).select("doc_id", tree.alias("tree"), whole.alias("hash"), F.when(tampered, changed).alias("changed"))
    leaves = numbered(leaves, "tree", "doc_id", "hash")

    kids = F.array_sort(F.collect_list(F.struct("idx", "doc_id", "hash", F.coalesce("changed", "hash").alias("folded"))))
    lone = F.col("of") == 1
    runs = leaves.groupBy("tree", _up().alias("up"), F.col("n").alias("of")).agg(kids.alias("k"))
    runs = runs.select(
        "tree", F.when(lone, 0).otherwise(1).alias("level"), F.col("up").alias("idx"), F.expr(f"(of + {RUN - 1}) div {RUN}").alias("n"),
        F.col("k.doc_id").alias("ids"), F.aggregate("k.hash", F.lit(b""), lambda a, b: F.concat(a, b)).alias("kids"),
        F.col("k.folded").alias("own"), lone.alias("lone"),
    )
    folded = F.transform("own", lambda f, j: hashed(F.concat(_before(F.col("kids"), j), f, _after(F.col("kids"), j))))
    runs = parked(
        runs.select(
            "tree", "level", "idx", "n", "ids", "kids", F.when(F.col("lone"), F.col("kids")).otherwise(hashed(F.col("kids"))).alias("hash"),
            F.when(F.col("lone"), F.col("own")).otherwise(folded).alias("folded"), F.lit(b"").alias("proof"),
        ),
        "runs",
    )

    link = ["tree", "level", "idx", "n", "hash"]
    levels = _levels(runs.select("tree", "idx", "n", "hash"), 2)
    every = [runs.select(*link), *[x.select(*link) for x in levels]]
    subroots = every[0].where("n = 1")
    for x in every[1:]:
        subroots = subroots.unionByName(x.where("n = 1"))
    ranks = numbered(subroots.select(F.lit(TOP).alias("top"), "tree", "hash"), "top", "tree")
    ranks = parked(ranks.select("tree", "hash", "idx", "n"), "subroots")
    top = _levels(ranks.select(F.lit(TOP).alias("tree"), "idx", "n", "hash"), 1)
    n_trees = ranks.count()
    if not n_trees:
        empty = F.lit(None).cast("string")
        return need(docs, "doc_id").select(
            "doc_id", *[empty.alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], F.lit(None).cast("boolean").alias("verified")
        )
    root = (top[-1] if top else ranks).first()["hash"]

    nodes = [_linked(x, ranks, n_trees > 1) for x in [*levels, *top]]
    if nodes:
        table = nodes[0]
        for x in nodes[1:]:
            table = table.unionByName(x)
    else:
        table = _linked(every[0].limit(0).withColumn("kids", F.lit(b"")), ranks, False)
    table = parked(table.select("tree", "level", "idx", "kids", "p_tree", "p_level", "p_idx", "p_pos"), "links")
    found = climbed(_linked(runs, ranks, n_trees > 1), table)

    found = found.join(ranks.select(F.col("tree").alias("r_tree"), F.col("hash").alias("subroot")), F.col("tree") == F.col("r_tree"))
    each = found.select("kids", "folded", "proof", "subroot", F.posexplode("ids").alias("j", "doc_id"))
    path = F.concat(_without(F.col("kids"), F.col("j")), F.col("proof"))
    reached = F.element_at("folded", F.col("j") + 1)
    text = lambda digest: F.lower(F.hex(digest))
    return each.select(
        "doc_id", text(F.col("kids").substr(F.col("j") * DIGEST + 1, F.lit(DIGEST))).alias("leaf"), text(F.col("subroot")).alias("subroot"),
        F.lit(bytes(root).hex()).alias("root"), F.sha2(text(path), 256).alias("proof_sha256"), text(reached).alias("folded_root"),
        (reached == F.lit(bytes(root))).alias("verified"),
    )
