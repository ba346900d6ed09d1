"""The trie of conversation prefixes, by peeling turns off the ends.

A prefix has a name: the exclusive or of 128-bit hashes of (place, turn digest) of its turns, so the names of all
prefixes of a conversation come from one running fold, and two prefixes are equal if their names are. Peeling starts at
the greatest depth. At each depth the conversations that end there meet the nodes that survived from below, rows of
equal name become one node with summed numbers, the node gives up its last turn, and what is left meets at the depth
above. Every number of a node is final when its depth is done, so nodes are found and counted in the same pass, and a
node is one row however many conversations share it: a first turn that a third of them have costs one row a task.

Depths are taken in bands that double in width. Within a band a row holds the names of its prefixes; those of the band
above are fetched for one conversation of each survivor. Rows that no other row of the band shares a prefix with are
peeled through the band at once; the others go depth by depth, wide bands by halves, so that depths where nothing meets
cost no round. A round is written to the shared folder, and only the greatest depth and whether anything is left go to
the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import durable_table, scratch_dir
from tidelog.llm.repair import crc32_sql
from tidelog.llm.turns import joined_digests, numbered, plain_turns, text_digest

#: Depths of the first band, which is also what is peeled without looking for lone rows, and of the widest ones.
NARROW, WIDE = 8, 1024
#: Ids whose text is joined at once.
IDS = 1 << 16
_SUMS = ("n", "kids", "leaves", "saved")


def _node(pick) -> list[Column]:
    return [pick(c).alias(c) for c in _SUMS]


class Bands:
    """(0, narrow], (narrow, 2 narrow], doubled up to `wide`, then bands of that width."""

    def __init__(self, narrow: int, wide: int):
        self.edges = [0]
        size = narrow
        while size <= wide:
            self.edges.append(size)
            size *= 2
        self.wide = self.edges[-1]

    def of(self, depth: Column) -> Column:
        doubled = reduce(lambda c, i: c.when(depth <= self.edges[i + 1], i), range(1, len(self.edges) - 1), F.when(depth <= self.edges[1], 0))
        return doubled.otherwise(len(self.edges) - 3 + F.ceil(depth / self.wide)).cast("int")

    def bounds(self, band: int) -> tuple[int, int]:
        if band < len(self.edges) - 1:
            return self.edges[band], self.edges[band + 1]
        low = (band - len(self.edges) + 2) * self.wide
        return low, low + self.wide


class Peeling:
    """One pass over the bands, from the deepest. Rows in work are

    cid (smallest member), at (depth), top_a, top_b (name at the foot of the band), steps (names and bytes so far, for
    each depth of the band up to `at`), n (members), kids, leaves and saved of what hangs below `at`.
    """

    def __init__(self, spark: SparkSession, steps: DataFrame, narrow: int, wide: int):
        self.spark, self.bands, self.narrow = spark, Bands(narrow, wide), narrow
        self.nodes: list[DataFrame] = []
        self.steps = self._banded(steps)

    def _banded(self, steps: DataFrame) -> DataFrame:
        """`cid, band, steps, top_a, top_b, ends`, a folder for each band."""
        rows = steps.select("cid", "depth", "bytes", self.bands.of(F.col("depth")).alias("band"), F.xxhash64(F.lit(7), "depth", "said").alias("a"), F.xxhash64(F.lit(11), "depth", "said").alias("b"))
        w = Window.partitionBy("cid", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = rows.select("cid", "band", "depth", F.bit_xor("a").over(w).alias("a"), F.bit_xor("b").over(w).alias("b"), F.sum("bytes").over(w).alias("sum"))
        by = run.groupBy("cid", "band").agg(F.array_sort(F.collect_list(F.struct("depth", "a", "b", "sum"))).alias("steps"))
        parts = durable_table(by, "steps")
        # one row a band: what a conversation brings into each of its bands
        last = F.element_at("steps", -1)
        before = Window.partitionBy("cid").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
        longer = parts.filter("band > 0").select("cid").distinct()
        brought = parts.select("cid", "band", last["a"].alias("a"), last["b"].alias("b")).join(longer, "cid").select(
            "cid", "band", F.bit_xor("a").over(before).alias("top_a"), F.bit_xor("b").over(before).alias("top_b"), F.lead("band").over(Window.partitionBy("cid").orderBy("band")).isNull().alias("ends"))
        none = F.lit(0).cast("long")
        full = parts.join(brought, ["cid", "band"], "left").select(
            "cid", "band", F.coalesce("top_a", none).alias("top_a"), F.coalesce("top_b", none).alias("top_b"), F.coalesce("ends", F.lit(True)).alias("ends"), "steps")
        named = F.transform("steps", lambda s: F.struct(s["a"].bitwiseXOR(F.col("top_a")).alias("a"), s["b"].bitwiseXOR(F.col("top_b")).alias("b"), s["sum"].alias("sum")))
        path = scratch_dir(self.spark, "bands")
        full.withColumn("steps", named).write.partitionBy("band").parquet(path)
        return self.spark.read.schema("cid long, top_a long, top_b long, ends boolean, steps array<struct<a:long,b:long,sum:long>>, band int").parquet(path)

    def ended(self) -> DataFrame:
        """`cid, depth, a, b` of whole conversations."""
        last = F.element_at("steps", -1)
        low = reduce(lambda c, i: c.when(F.col("band") == i, self.bands.edges[i]), range(1, len(self.bands.edges) - 1), F.when(F.col("band") == 0, 0))
        foot = low.otherwise((F.col("band") - len(self.bands.edges) + 2) * self.bands.wide)
        return self.steps.filter("ends").select("cid", (foot + F.size("steps")).cast("long").alias("depth"), last["a"].alias("a"), last["b"].alias("b"))

    def _put(self, rows: DataFrame, low: int, depth: Column, kids: Column) -> DataFrame:
        """Nodes of `rows` at `depth`, whose numbers below are final."""
        i = (depth - low).cast("int")
        here, above = F.get("steps", i - 1), F.get("steps", i - 2)
        own = (F.element_at("steps", -1)["sum"] - F.coalesce(above["sum"], F.lit(0))) * (F.col("n") - 1)  # of all turns from here on
        return rows.select(
            "cid", depth.cast("long").alias("depth"), here["a"].alias("a"), here["b"].alias("b"), F.coalesce(above["a"], F.col("top_a")).alias("up_a"), F.coalesce(above["b"], F.col("top_b")).alias("up_b"),
            "n", kids.alias("kids"), F.greatest("leaves", F.lit(1).cast("long")).alias("leaves"), (F.col("saved") + own).alias("saved"),
        )

    def _meet(self, rows: DataFrame) -> DataFrame:
        """Rows of one depth and name become one; their steps are equal."""
        return rows.withColumn("_", F.element_at("steps", -1)).groupBy("at", F.col("_.a").alias("a"), F.col("_.b").alias("b")).agg(
            F.min("cid").alias("cid"), F.first("top_a").alias("top_a"), F.first("top_b").alias("top_b"), F.first("steps").alias("steps"), *_node(F.sum)).drop("a", "b")

    @staticmethod
    def _cut(rows: DataFrame, low: int, to: int) -> DataFrame:
        """What final rows without company give to depth `to`: one child each, its last turns gone."""
        gone = F.element_at("steps", -1)["sum"] - F.coalesce(F.get("steps", F.lit(to - low - 1))["sum"], F.lit(0))
        return rows.select(
            "cid", F.lit(to).cast("long").alias("at"), "top_a", "top_b", F.slice("steps", 1, to - low).alias("steps"), "n", F.lit(1).cast("long").alias("kids"),
            F.greatest("leaves", F.lit(1).cast("long")).alias("leaves"), (F.col("saved") + gone * (F.col("n") - 1)).alias("saved"))

    def _by_depth(self, rows: DataFrame, foot: int, low: int) -> DataFrame | None:
        top = rows.agg(F.max("at")).first()[0]
        left = None
        for depth in range(top or foot, foot, -1):
            here = rows.filter(F.col("at") == depth)
            level = durable_table(self._meet(here if left is None else here.unionByName(left)), "level")
            self.nodes.append(self._put(level, low, F.lit(depth), F.col("kids")))
            left = self._cut(level, low, depth - 1)
        return left

    def _peel(self, rows: DataFrame, foot: int, head: int, low: int) -> DataFrame | None:
        """Peel depths (foot, head] of the band that begins behind depth `low`; returns what is left at `foot`."""
        if head - foot <= self.narrow:
            return self._by_depth(durable_table(rows, "rows"), foot, low)
        rows = self._meet(rows)
        first = F.get("steps", F.lit(foot - low))
        named = durable_table(rows.withColumn("a", first["a"]).withColumn("b", first["b"]), "rows")
        crowds = named.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("a", "b", F.lit(True).alias("crowd"))
        told = durable_table(named.join(crowds, ["a", "b"], "left").drop("a", "b"), "told")
        lone = told.filter("crowd IS NULL").drop("crowd")
        chain = lone.withColumn("depth", F.explode(F.sequence(F.lit(foot + 1).cast("long"), F.col("at"))))
        kids = F.when(F.col("depth") == F.col("at"), F.col("kids")).otherwise(F.lit(1))
        self.nodes.append(self._put(chain, low, F.col("depth"), kids))
        left = self._cut(lone, low, foot)
        together = told.filter("crowd").drop("crowd")
        if together.isEmpty():
            return left
        middle = (foot + head) // 2
        upper = self._peel(together.filter(F.col("at") > middle), middle, head, low)
        lower = together.filter(F.col("at") <= middle)
        lower = self._peel(lower if upper is None else lower.unionByName(upper), foot, middle, low)
        return left if lower is None else left.unionByName(lower)

    def run(self) -> DataFrame:
        """All nodes but the root, and as `left` the children of the root: `cid, n, kids, leaves, saved`."""
        deepest = self.steps.agg(F.max("band")).first()[0]
        zero = F.lit(0).cast("long")
        left = None
        for band in range(-1 if deepest is None else deepest, -1, -1):
            low, high = self.bands.bounds(band)
            here = self.steps.filter(F.col("band") == band).drop("band")
            over = here.filter("ends").select("cid", (F.size("steps") + low).cast("long").alias("at"), "top_a", "top_b", "steps", F.lit(1).cast("long").alias("n"), zero.alias("kids"), zero.alias("leaves"), zero.alias("saved"))
            if left is not None:
                over = over.unionByName(left.join(here.drop("ends"), "cid").withColumn("at", F.lit(high).cast("long")).select(*over.columns))
            left = self._peel(over, low, high, low)
            left = durable_table(left.select("cid", *_SUMS), "left") if left is not None else None
        return left


def _ends(ended: DataFrame) -> DataFrame:
    """`depth, a, b, ends_sha256` of nodes where conversations end; at most IDS ids are joined at once, and the joined
    pieces of a node that has more go through one running digest."""
    name = ["depth", "a", "b"]
    chunk = F.floor(F.col("cid") / IDS).alias("chunk") if IDS & (IDS - 1) else F.shiftright("cid", IDS.bit_length() - 1).alias("chunk")
    text = F.array_join(F.transform(F.array_sort(F.collect_list("cid")), lambda x: x.cast("string")), ",")
    pieces = durable_table(ended.groupBy(*name, chunk).agg(text.alias("ids")), "ends")
    many = pieces.groupBy(*name).agg(F.count(F.lit(1)).alias("_n"), F.first("ids").alias("ids"))
    single = many.filter("_n = 1").select(*name, F.sha2(F.col("ids"), 256).alias("ends_sha256"))
    long = pieces.join(many.filter("_n > 1").select(*name), name)
    return single.unionByName(joined_digests(long, name, ["chunk"], F.col("ids"), ",").withColumnRenamed("digest", "ends_sha256"))


def trie(convs: DataFrame, steps: DataFrame, narrow: int = NARROW, wide: int = WIDE) -> DataFrame:
    """The nodes of the trie of `convs` (cid) and their turns, `steps` (cid, depth from 1 without gaps, said: a digest of
    role and text, bytes): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Every id of `steps` must be in `convs`, whose ids are distinct and not null; one without steps is a member of the
    root alone. No conversations, no root. Equal conversations are members of the same nodes.
    """
    spark = convs.sparkSession
    work = Peeling(spark, steps, narrow, wide)
    left = work.run()
    zero = F.lit(0).cast("long")
    ended = work.ended()
    silent = convs.join(ended.select("cid"), "cid", "left_anti")
    below = silent.select("cid", F.lit(1).cast("long").alias("n"), *[zero.alias(c) for c in _SUMS[1:]])
    if left is not None:
        below = below.unionByName(left)
    root = durable_table(below.agg(F.min("cid").alias("cid"), *_node(F.sum)).filter("n > 0"), "root")
    name = ["depth", "a", "b"]
    top = root.select("cid", *[zero.alias(c) for c in (*name, "up_a", "up_b")], "n", "kids", F.greatest("leaves", F.lit(1).cast("long")).alias("leaves"), "saved")
    nodes = durable_table(reduce(DataFrame.unionByName, work.nodes, top), "nodes")
    # the root has the most children, and no join
    first = (root.first() or [None])[0]
    inner = nodes.filter("depth > 1").join(nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("cid").alias("parent")), ["depth", "up_a", "up_b"])
    outer = nodes.filter("depth <= 1").withColumn("parent", F.when(F.col("depth") == 1, F.lit(first).cast("long")))
    all_ends = _ends(ended.unionByName(silent.select("cid", *[zero.alias(c) for c in name])))
    out = inner.unionByName(outer).join(all_ends, name, "left")
    return out.select(
        F.col("cid").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def rebuilt(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """`convs` and `steps` for `trie`: each conversation c gets the first crc32(c) % 9 turns of c - c % 5 in place of its own.

    Turns come in the order of `turn`, null first, those of one turn by role and digest of the text; a null role or text
    is empty; a row with a null id belongs to no conversation.
    """
    plain = plain_turns(turns, conv_col, turn_col, role_col, text_col, "").filter("NOT absent")
    light = plain.select("absent", "cid", "turn", "role", text_digest("text").alias("text_said"), text_digest("role", "text").alias("said"), F.octet_length("text").cast("long").alias("bytes"))
    own = durable_table(numbered(light, ["turn", "role", "text_said"]).select("cid", "pos", "said", "bytes"), "turns")
    sizes = own.groupBy("cid").agg(F.count(F.lit(1)).alias("size"))
    convs = sizes.withColumn("base", F.col("cid") - F.col("cid") % 5).withColumn("h", F.crc32(F.encode(F.col("cid").cast("string"), "UTF-8")) % 9)
    have = sizes.select(F.col("cid").alias("base"), F.col("size").alias("base_size"))
    convs = durable_table(convs.join(have, "base", "left").select("cid", "base", "h", F.least("h", F.coalesce("base_size", F.lit(0))).alias("taken")), "convs")
    front = own.filter("pos < 8").withColumnRenamed("cid", "base").join(convs, "base").filter("pos < h").select("cid", (F.col("pos") + 1).alias("depth"), "said", "bytes")
    back = own.join(convs, "cid").filter("pos >= h").select("cid", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "said", "bytes")
    return convs.select("cid"), front.unionByName(back)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(*rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


QUERIES = {"op11_prefix_trie": op11_prefix_trie}
ORACLES = {
    "op11_prefix_trie": f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(CAST(length(coalesce(text, '')) AS VARCHAR) || ':' || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, count(*) AS size, conv_id - conv_id % 5 AS base, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own GROUP BY conv_id),
shaped AS (
  SELECT c.*, least(c.h, coalesce(b.size, 0)) AS taken FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
steps AS (
  SELECT c.conv_id, o.pos AS depth, role, text FROM shaped c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, c.taken + o.pos - c.h, role, text FROM shaped c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
whole AS (
  SELECT c.conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY depth) FILTER (depth IS NOT NULL), []) AS said
  FROM shaped c LEFT JOIN steps s ON s.conv_id = c.conv_id GROUP BY c.conv_id),
members AS (
  SELECT conv_id, unnest(range(0, len(said) + 1)) AS depth, said FROM whole),
named AS (
  SELECT conv_id, depth, said[1:depth] AS path, len(said) AS size FROM members),
node AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, path[1:depth - 1] AS up,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth) AS ends FROM named GROUP BY depth, path),
kids AS (
  SELECT depth - 1 AS depth, up AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY depth, up),
full_node AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.path[n.depth].text) END AS saved
  FROM node n LEFT JOIN kids k ON k.depth = n.depth AND k.path = n.path),
below AS (
  SELECT path[1:d] AS path, d AS depth, n_children, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_node)),
sums AS (
  SELECT depth, path, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM below GROUP BY depth, path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM full_node n JOIN sums s ON s.depth = n.depth AND s.path = n.path
LEFT JOIN node p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.up"""
}
