"""Near-duplicate removal: greedy leaders by Jaccard similarity of character n-gram sets.

Rows are visited in ``ord`` order; a row is dropped iff some earlier *kept* row has similarity >= t, and it
is attributed to the first such row.  (This is not connected components: with A~B, B~C and A, C unlike,
both A and C stay.)  The result is exactly that of the sequential rule, computed as Spark jobs:

1. Rows with equal texts behave alike, so only the first of them takes part (``groupBy`` with map-side
   combine: a group of copies of any size becomes one row).
2. Rows become blocks of similar size (``functions/blocks.py``) with their parities, which bound the similarity exactly, and the tokens of an index, if one is named:
   the rarest members of a set (``RareTokens``) or MinHash.  Blocks of close sizes meet in a task, which compares parities of all pairs of their rows
   (for MinHash of those that share a token) and counts shared tokens; only pairs that pass every bound are written.
3. Rounds.  A row meets its first few such earlier rows of a block, the *heads*.  If there are more, what lies behind the last of them is *cut*: the row cannot be kept
   yet, but it can be dropped, and a bucket of near copies is done after one round, because a kept head drops them.  Undecided rows alone go into
   the next round, behind their cuts, against the rows that aren't dropped, with ``GROWTH`` times as many heads; none caps results.
   ``index="groups"`` takes tokens of groups of members (``PigeonholeTokens``) in place of blocks: a task pairs the rows of each token, and of crowded ones the heads.
4. The similar pairs found so far are split into connected components, and a component is walked in order as a stream: one step
   decides all rows, however long a chain of drifting texts is (``greedy_walk``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import blocks as B
from corpusloom.functions import grams as G
from corpusloom.functions import text as X
from corpusloom.functions.frames import materialize, once
from corpusloom.functions.rounding import python_round
from corpusloom.operators.graph import components
from corpusloom.operators.ordering import add_position

FIRST_BUCKET = 128  # rows of a bucket that are all paired in the first round
GROWTH = 16  # of buckets and heads from round to round
HEAD_SHARE = 32  # a larger bucket has this fraction of the above as heads
PART_CHARS = 1 << 22  # of texts whose rows a task puts into blocks, about
PART_TOKENS = 1 << 20  # that a task pairs at once in the first round, about
SENT_KEYS = 1 << 20  # at most as many are sent to all tasks


@dataclass(frozen=True)
class NearDedup:
    rows: DataFrame  # all input rows
    ids: DataFrame  # ord, id of all input rows
    dropped: DataFrame  # ord, leader_ord, similarity
    threshold: float
    ngram_size: int
    method: str

    @property
    def kept(self) -> DataFrame:
        return self.rows.join(self.dropped.select("ord"), "ord", "left_anti")

    @property
    def pairs(self) -> DataFrame:
        """(ord, record_id, duplicate_of, similarity rounded to 4 digits) of each dropped row."""
        ids = self.ids
        leaders = self.dropped.select(F.col("leader_ord").alias("ord")).distinct().join(ids, "ord")
        leaders = leaders.select(F.col("ord").alias("leader_ord"), F.col("id").alias("duplicate_of"))
        return (
            self.dropped.join(ids.withColumnRenamed("id", "record_id"), "ord")
            .join(leaders, "leader_ord")
            .select("ord", "record_id", "duplicate_of", python_round(F.col("similarity"), 4).alias("similarity"))
        )

    @property
    def stats(self) -> DataFrame:
        """One row of totals.

        ``comparisons`` is what the sequential rule would need: a kept row meets all rows kept before it, a
        dropped one all kept rows up to its leader.
        """
        ranks = add_position(self.ids.select("ord").join(self.dropped.select("ord"), "ord", "left_anti"), [F.col("ord")], "rank")
        by_leader = self.dropped.groupBy("leader_ord").agg(F.count("*").alias("n"))
        met = ranks.join(by_leader, ranks["ord"] == by_leader["leader_ord"], "left").agg(
            F.count("*").alias("output_records"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("duplicates_removed"),
            F.coalesce(F.sum(F.col("rank") - 1 + F.coalesce("n", F.lit(0)) * F.col("rank")), F.lit(0)).alias("comparisons"),
        )
        return met.select(
            F.lit("char_ngram_jaccard" if self.method == "exact" else "char_ngram_minhash").alias("method"),
            (F.col("output_records") + F.col("duplicates_removed")).alias("input_records"),
            "output_records",
            "duplicates_removed",
            F.lit(float(self.threshold)).alias("threshold"),
            F.lit(self.ngram_size).cast("bigint").alias("ngram_size"),
            "comparisons",
        )


def near_dedup(df: DataFrame, threshold: float = 0.85, ngram_size: int = 5, method: str = "exact", index: str | None = None) -> NearDedup:
    """Near deduplication of rows (ord, id, text, ...).

    ``method`` chooses the candidates: "exact" finds every pair; "minhash" takes far fewer tokens per row
    in bands that follow from the threshold, and finds a pair at the threshold with a probability of .9999 or more.  Every candidate is
    checked by its true similarity in both.  ``index`` names the tokens of the exact method, "rare" or "groups"; by default the threshold decides.
    """
    if index not in (None, "rare", "groups", "parities"):
        raise ValueError(f"no such index: {index}")
    rows = once(df.select("ord", "id", "text"), gram_text=X.gram_form("text")).select("ord", "id", "gram_text")
    if threshold > 1:
        dropped = rows.select("ord", F.col("ord").alias("leader_ord"), F.lit(1.0).alias("similarity")).limit(0)
    elif threshold <= 0:
        dropped = _all_like_the_first(rows, ngram_size)
    else:
        rows = materialize(rows, "gram-texts")  # whatever the rows come from is evaluated once
        if method == "minhash":
            tokens = G.MinHashTokens(threshold)
        elif index == "groups":
            tokens = G.PigeonholeTokens(threshold)
        elif index == "rare":
            tokens = G.RareTokens(threshold, G.gram_counts(rows, ngram_size, G.RareTokens.SLOTS))
        else:
            tokens = B.ParityBounds(threshold)
        dropped = _drop(rows, threshold, ngram_size, tokens)
    return NearDedup(df, rows.select("ord", "id"), dropped, threshold, ngram_size, method)


def _drop(rows: DataFrame, threshold: float, n: int, tokens) -> DataFrame:
    rows = rows.withColumn("digest", F.md5("gram_text"))
    groups = rows.groupBy("digest").agg(F.min("ord").alias("first_ord"), F.count("*").alias("copies"), F.min(F.length("gram_text")).alias("length"))
    copies = rows.select("ord", "digest").join(groups.filter("copies > 1"), "digest").filter("ord > first_ord").select("ord", "first_ord")
    copies = materialize(copies, "copies")
    distinct = rows.join(copies.select("ord"), "ord", "left_anti")
    members = groups.agg(F.sum("length")).first()[0] or 0
    rounds = _by_tokens if isinstance(tokens, G.PigeonholeTokens) else _by_size
    dropped = rounds(rows, distinct, members, threshold, n, tokens)

    # A further copy of a set follows its first row: to that row's leader, or to the row itself.
    leaders = dropped.withColumnRenamed("ord", "first_ord")
    copies = copies.join(leaders, "first_ord", "left").select(
        "ord", F.coalesce("leader_ord", "first_ord").alias("leader_ord"), F.coalesce("similarity", F.lit(1.0)).alias("similarity")
    )
    return materialize(dropped.unionByName(copies), "dropped")


def _by_size(rows: DataFrame, distinct: DataFrame, members: int, threshold: float, n: int, tokens) -> DataFrame:
    """(ord, leader_ord, similarity) of the distinct rows that are dropped, from blocks of rows of similar size."""
    bounds = G.RareTokens(threshold) if tokens.counted else tokens  # pairs need no counts
    parts = max(1, -(-members // (PART_CHARS * (B.WIDER if tokens.joined else 1))))
    block_rows = materialize(B.block_rows(distinct, n, tokens), "block-rows")
    blocks = materialize(B.packed(_by_sizes(block_rows, parts), bounds), "blocks")
    his, los = blocks, blocks

    edges: list[DataFrame] = []
    bucket = FIRST_BUCKET
    while True:
        near = materialize(B.near_pairs(his, los, bounds, max(2, bucket // HEAD_SHARE)), "near")
        cuts = materialize(near.filter("lo IS NULL").groupBy("hi").agg(F.min("cut").alias("cut")), "cuts")
        pairs = near.filter("lo IS NOT NULL").drop("cut").join(cuts, "hi", "left").filter("cut IS NULL OR lo <= cut").select("lo", "hi").distinct()
        edges.append(materialize(_similar(rows, pairs, n, threshold), "similar"))
        decided = materialize(_walked(reduce(DataFrame.union, edges), cuts.select(F.col("hi").alias("ord"))), "decided")
        dropped = decided.filter("leader_ord IS NOT NULL")
        # A dropped row's leader stands before its cut, so what comes behind it doesn't matter; and dropped rows lead nothing.
        undecided = materialize(cuts.withColumnRenamed("hi", "ord").join(dropped.select("ord"), "ord", "left_anti"), "undecided")
        if undecided.isEmpty():
            return dropped
        later = materialize(block_rows.drop("cut").join(_few(undecided), "ord"), "later")
        his = materialize(B.packed(_by_sizes(later, 1 + later.count() // B.BLOCK_ROWS), bounds), "blocks")
        los = B.packed(B.unpacked(blocks).join(_few(dropped.select("ord")), "ord", "left_anti"), bounds)
        bucket *= GROWTH


def _by_sizes(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartitionByRange(parts, "size", "ord").sortWithinPartitions("size", "ord")


def _few(keys: DataFrame) -> DataFrame:
    """Keys (a written table) that are sent to all tasks unless they are many."""
    return F.broadcast(keys) if keys.count() <= SENT_KEYS else keys


def _by_tokens(rows: DataFrame, distinct: DataFrame, members: int, threshold: float, n: int, tokens) -> DataFrame:
    """(ord, leader_ord, similarity) of the distinct rows that are dropped, from rows that share a token."""
    parts = max(1, -(-tokens.expected(members) // PART_TOKENS))

    met: DataFrame | None = None
    edges: list[DataFrame] = []
    bucket = FIRST_BUCKET
    while True:
        heads = max(2, bucket // HEAD_SHARE)
        if met is None:
            dealt = G.sketches(distinct, n, tokens, parts).repartition(parts, "part").sortWithinPartitions("part")
            met = materialize(G.first_meetings(dealt, tokens, bucket, heads, parts), "met")
            sketched = met.filter("row IS NOT NULL").select(F.col("row").alias("ord"), "size", "bits", "parity")
        else:
            dealt = entries.repartition("token").sortWithinPartitions("token", "gone", "ord")
            met = materialize(G.meetings(dealt, tokens, bucket, heads, parts), "met")
        crowded = met.filter("token IS NOT NULL")
        open_rows = crowded.filter("behind").select("ord").distinct()
        pairs = _plausible(met, sketched, crowded, tokens, parts)
        edges.append(materialize(_similar(rows, pairs, n, threshold), "similar"))
        decided = materialize(_walked(reduce(DataFrame.union, edges), open_rows), "decided")
        dropped = decided.filter("leader_ord IS NOT NULL")
        undecided = open_rows.join(dropped.select("ord"), "ord", "left_anti").union(decided.filter("leader_ord IS NULL").select("ord")).distinct()
        states = undecided.select("ord", F.lit(False).alias("gone")).union(dropped.select("ord", F.lit(True)))
        # Dropped rows stay: they may find an earlier leader among the rows that are undecided.
        entries = materialize(crowded.select("token", "ord", "facts").join(states, "ord").select("token", "ord", "facts", "gone"), "crowded")
        if entries.filter("NOT gone").isEmpty():
            return dropped
        bucket *= GROWTH


def _plausible(met: DataFrame, sketched: DataFrame, crowded: DataFrame, bounds, parts: int) -> DataFrame:
    """Pairs (lo, hi) of a round that may be similar by the tokens that they share and by their sketches.

    What they share is what has been seen, and at most as many more as either row has crowded tokens.  That bound is final, so a round decides each pair that it
    meets and none needs what others have seen.  Most pairs are unrelated and fall short; they travel in packs, once, and meet no sketches.
    """
    hidden = materialize(crowded.groupBy("cell", "ord").agg(F.count("*").alias("hidden")), "hidden")
    packs = met.filter("pairs IS NOT NULL").select("cell", *G.PAIR_COLUMNS)
    dealt = packs.unionByName(hidden, allowMissingColumns=True)
    counted = G.counted_pairs(dealt.repartition(parts, "cell").sortWithinPartitions("cell"))
    counted = counted.join(hidden.select(F.col("ord").alias("hi"), "hidden"), "hi", "left").filter("short <= coalesce(hidden, 0)")
    both = materialize(counted.select("lo", "hi"), "counted")
    sketched = _of_pairs(sketched, both)
    side = sketched.select("ord", F.struct("size", "bits").alias("side"))
    both = both.join(side.toDF("lo", "a"), "lo").join(side.toDF("hi", "b"), "hi")
    # The parities are the widest by far: only pairs that pass without them fetch them.
    both = both.filter(bounds.plausible).select("lo", "hi", F.col("a.size").alias("lo_size"), F.col("b.size").alias("hi_size"))
    for row in ("lo", "hi"):
        both = both.join(sketched.select(F.col("ord").alias(row), F.col("parity").alias(f"{row}_parity")), row)
    return G.alike_enough(both, bounds.t)


def _of_pairs(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows that pairs (a written table) need; a join would shuffle all others as well, unless it is told that the pairs' keys are few."""
    wanted = pairs.select(F.col("lo").alias("ord")).union(pairs.select("hi")).distinct()
    return rows.join(_few(wanted), "ord", "left_semi")


def _similar(rows: DataFrame, pairs: DataFrame, n: int, threshold: float) -> DataFrame:
    """(lo, hi, similarity) of the candidate pairs that reach the threshold."""
    pairs = materialize(pairs, "pairs")
    texts = _of_pairs(rows.select("ord", "gram_text"), pairs)
    both = pairs.join(texts.toDF("lo", "lo_text"), "lo").join(texts.toDF("hi", "hi_text"), "hi")
    return G.similarities(both, n, threshold)


def _walked(edges: DataFrame, open_rows: DataFrame) -> DataFrame:
    """(ord, leader_ord, similarity) of the rows that are dropped, and with nulls of those that wait for an open row."""
    roots = components(edges.select(F.col("lo").alias("a"), F.col("hi").alias("b")))
    pairs = edges.join(roots.withColumnRenamed("node", "lo"), "lo")
    for side in ("lo", "hi"):
        pairs = pairs.join(open_rows.select(F.col("ord").alias(side), F.lit(True).alias(f"{side}_open")), side, "left")
    pairs = pairs.withColumns({f"{side}_open": F.coalesce(f"{side}_open", F.lit(False)) for side in ("lo", "hi")})
    return G.greedy_walk(pairs.repartition("root").sortWithinPartitions("root", "hi", "lo"))


def _all_like_the_first(rows: DataFrame, n: int) -> DataFrame:
    """A threshold of zero or less: every later row is dropped for the first one."""
    sets = materialize(G.gram_sets(rows, n), "sets")
    first = sets.orderBy("ord").limit(1)
    grams = sets.select("ord", F.explode("grams").alias("gram"))
    shared = grams.join(first.select(F.explode("grams").alias("gram")), "gram", "left_semi").groupBy("ord").agg(F.count("*").alias("shared"))
    one = first.select(F.lit(1).alias("_all"), F.col("ord").alias("leader_ord"), F.size("grams").alias("first_size"))
    sized = sets.select("ord", F.size("grams").alias("size"), F.lit(1).alias("_all")).join(F.broadcast(one), "_all")
    union = F.col("size") + F.col("first_size") - F.coalesce("shared", F.lit(0))
    similarity = F.when(union == 0, F.lit(1.0)).otherwise(F.coalesce("shared", F.lit(0)) / union)
    return (
        sized.join(shared, "ord", "left").filter("ord > leader_ord").select("ord", "leader_ord", similarity.alias("similarity"))
    )
