"""Exact Jaccard join of documents on word shingles, with several global token orders.

Documents are sets of hashed word shingles. Two sets with a Jaccard similarity of at least t
share a token among the first ``n - ceil(t n) + 1`` tokens of each, under any total order of
all tokens. So candidates must share such a prefix token under three different orders:

* The first order finds candidates. It splits the hash space into a few classes and puts one
  class first, in it tokens of few documents first. Only tokens of that class need counting
  (of the next too, where a document has too few), and passages that many documents share
  come last, so they rarely lead to candidates.
* Two more orders rank all tokens by other hashes. They are looked at for the candidates
  only, and what passes all filters is verified on the whole sets.

Candidates are not expanded into all pairs of the documents that share a token. Every token
has a pivot, the document with the fewest tokens of its own, and each document is compared
with the pivots of its tokens. Links found so join most of each group of near copies. What
is left are documents of a token in different components. Near their pivot they are known by
what they differ in, and the differences must overlap for two of them to link: a join on the
rarest tokens of the differences finds those pairs. Documents far from their pivot are joined
on their own rarest tokens. So no link between components is missed, and a group of near copies costs
about as many comparisons as it has members and changes in common.

Equal texts are one document here until the end.

Defined results: null and empty texts and texts without words have the empty set, which links
with nothing; a text with fewer words than a shingle has its whole word sequence as its only
shingle; a doc_id names one document, so rows that repeat it repeat its text, count as one
node and are all returned; rows with a null doc_id are compared with nothing, have no
shingles and a null component; very long texts are sets like any others; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.llm.common import bounded_broadcast, list_column, store
from clickmill.llm.components import connected_components
from clickmill.llm.text import Texts, chunks

# Differences of up to this share of both sets (Jaccard 0.4) make a document near its pivot.
NEAR_PERCENT = 43
# Ratio of the sizes of differences that one prefix length serves.
BAND = 1.15


def _prefix(n: int, percent: int) -> int:
    return n - (n * percent + 99) // 100 + 1


def _lower_sets(column: pa.Array, words: int) -> Iterator[tuple[slice, list[np.ndarray]]]:
    for rows, texts in chunks(column):
        lowered = Texts(texts.data, texts.offsets, lower=True)
        yield rows, lowered.shingle_sets(words)


def _text_classes(docs: DataFrame) -> DataFrame:
    """``doc_id`` and two hashes of the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("h1"), F.hash(text).alias("h2"))


def _representatives(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, rep) of the documents whose text a smaller doc_id has, and all other documents."""
    classes = store(_text_classes(docs.filter("doc_id is not null")), "text-classes")
    reps = classes.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")
    )
    reps = reps.filter("n > 1").select("h1", "h2", "rep")
    copies = classes.join(reps, ["h1", "h2"]).filter("doc_id <> rep").select("doc_id", "rep")
    copies = store(copies.distinct(), "copies")
    ids = bounded_broadcast(copies.select("doc_id"), 8)
    rest = docs.select("doc_id", "text").filter("doc_id is not null")
    return copies, rest.join(ids, "doc_id", "left_anti")


def _class_tokens(docs: DataFrame, words: int, percent: int, classes: int) -> DataFrame:
    """Tokens of each document by class, as far as its prefix can reach.

    One row per document and class: ``n`` is the size of the set, ``before`` the tokens of
    earlier classes, ``here`` those of this class.
    """
    width = np.uint64((1 << 64) // classes + 1)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sets in _lower_sets(batch.column(1), words):
                at, size, number, before, here, tokens = [], [], [], [], [], []
                for i, own in enumerate(sets):
                    n = len(own)
                    cuts = np.searchsorted(own // width, np.arange(classes + 1))
                    for k in range(classes):
                        if n and cuts[k] >= _prefix(n, percent):
                            break
                        if n == 0 and k:
                            break
                        at.append(i)
                        size.append(n)
                        number.append(k)
                        before.append(cuts[k])
                        here.append(cuts[k + 1] - cuts[k])
                        tokens.append(own[cuts[k] : cuts[k + 1]].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[rows].take(pa.array(at, pa.int64())),
                        *(pa.array(x, pa.int32()) for x in (size, number, before, here)),
                        list_column(tokens, pa.int64()),
                    ],
                    ["doc_id", "n", "class", "before", "here", "tokens"],
                )

    schema = "doc_id long, n int, class int, before int, here int, tokens array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(compute, schema)


def _prefix_tokens(tokens: DataFrame, percent: int) -> DataFrame:
    """Tokens in the prefix of the first order that other sets have too.

    (token, doc_id, n, lone), where ``lone`` counts the tokens of the class no other set has.
    """
    sets = tokens.select("doc_id", "n", "class", "before", "here", F.explode("tokens").alias("token"))
    counts = sets.groupBy("token").agg(F.count(F.lit(1)).alias("documents"))
    shared = sets.join(counts.filter("documents > 1"), "token")
    own = Window.partitionBy("doc_id", "class")
    lone = F.col("here") - F.count(F.lit(1)).over(own)
    place = F.row_number().over(own.orderBy("documents", "token"))
    ranked = shared.withColumns({"lone": lone, "place": place})
    prefix = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    within = F.col("before") + F.col("lone") + F.col("place") <= prefix
    return ranked.filter(within).select("token", "doc_id", "n", "lone")


def _long_enough(percent: int, n: str = "n", m: str = "m") -> Column:
    """Whether the sizes of two sets allow the similarity."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _posted(entries: DataFrame) -> DataFrame:
    """Documents of each token with its pivot, the document with the fewest lone tokens.

    In a group of near copies that is one close to what they were copied from.
    """
    own = F.min(F.struct("lone", "doc_id", "n"))
    pivots = entries.groupBy("token").agg(own.alias("p"), F.count(F.lit(1)).alias("documents"))
    pivots = pivots.filter("documents > 1").select(
        "token", F.col("p.doc_id").alias("pivot"), F.col("p.n").alias("m")
    )
    return entries.join(pivots, "token").filter("doc_id <> pivot").drop("lone")


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _open_postings(posted: DataFrame, components: DataFrame) -> DataFrame:
    """Postings, with components, of the tokens that lead to more than one component."""
    placed = posted.join(components, posted["doc_id"] == components["node"], "left").select(
        *posted.columns, F.coalesce("component", "doc_id").alias("component")
    )
    several = placed.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    return placed.join(several.filter("low < high").select("token"), "token")


def _differences(groups: DataFrame, profiles: DataFrame) -> DataFrame:
    """What sets the documents of a pivot apart from it, where they are near it.

    ``x`` is the number of tokens in only one of the two, ``apart`` their Jaccard distance.
    """
    sets = profiles.select("id", "tokens")
    own, pivot = sets.alias("own"), sets.alias("other")
    x = F.col("n") + F.col("m") - 2 * F.size(F.array_intersect("own.tokens", "other.tokens"))
    met = (
        groups.join(own, F.col("doc_id") == F.col("own.id"))
        .join(pivot, F.col("pivot") == F.col("other.id"))
        .withColumn("x", x)
        .withColumn("near", 100 * F.col("x") <= NEAR_PERCENT * (F.col("n") + F.col("m")))
    )
    change = F.concat(
        F.array_except("own.tokens", "other.tokens"), F.array_except("other.tokens", "own.tokens")
    )
    return met.select(
        *groups.columns,
        "x",
        (2 * F.col("x") / (F.col("n") + F.col("m") + F.col("x"))).alias("apart"),
        "near",
        F.when(F.col("near"), change).alias("change"),
    )


def _near_pairs(differences: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents near one pivot whose differences from it overlap enough.

    With x and y tokens of difference, two sets are apart in x + y tokens less twice those
    common to both differences, and at most in ``alpha`` times the sum of their sizes, which
    is at most 2 m + x + y. So the differences must share a number of tokens that follows
    from x and y, which calls for the prefix filter again, tokens rarest in the group first.
    The filter is set for y in bands, so that the smaller difference has short prefixes. If
    nothing need be shared, both documents link with the pivot, and are done with.
    """
    alpha = (100 - percent) / (100 + percent)
    free = F.lit(2 * alpha) * F.col("m")
    tokens = differences.filter("near").select(
        "pivot", "m", "doc_id", "component", "x", F.explode("change").alias("token")
    )
    counts = tokens.groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("documents"))
    shared = tokens.join(counts.filter("documents > 1"), ["pivot", "token"])
    own = Window.partitionBy("pivot", "doc_id")
    ranked = shared.withColumn(
        "rank",
        F.col("x")
        - F.count(F.lit(1)).over(own)
        + F.row_number().over(own.orderBy("documents", "token")),
    )
    ranked = store(ranked.drop("documents"), "difference-tokens")

    def band(size: Column) -> Column:
        return F.floor(F.log(size.cast("double")) / F.lit(float(np.log(BAND)))).cast("int")

    def reach(common: Column) -> Column:
        """Prefix that holds one of ``common`` shared tokens at least."""
        return F.col("x") - F.greatest(F.ceil(common - 1e-6), F.lit(1)) + 1

    larger = ranked.filter(
        F.col("rank") <= reach(((1 - alpha) * F.col("x") - free) / (1 + alpha))
    ).select("pivot", "token", band(F.col("x")).alias("band"), "doc_id", "component", "x")
    # The smaller difference holds all that is shared, which bounds the larger.
    most = F.floor((2 * F.col("x") + free) / (1 - alpha) - F.col("x") + 1e-6)
    bands = F.sequence(band(F.col("x")), band(F.greatest(most, F.col("x"))))
    least = F.greatest(F.floor(F.pow(F.lit(BAND), F.col("band")) - 1e-6), F.col("x"))
    smaller = ranked.withColumn("band", F.explode(bands)).filter(
        F.col("rank") <= reach(((1 - alpha) * (F.col("x") + least) - free) / 2)
    )
    smaller = smaller.select(
        "pivot",
        "token",
        "band",
        F.col("doc_id").alias("o"),
        F.col("component").alias("other"),
        F.col("x").alias("y"),
    )
    met = larger.join(smaller, ["pivot", "token", "band"]).filter(
        (F.col("component") != F.col("other"))
        & ((F.col("y") < F.col("x")) | ((F.col("y") == F.col("x")) & (F.col("o") < F.col("doc_id"))))
    )
    return met.select(*_ordered("doc_id", "o"))


def _far_pairs(differences: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Pairs of which one document at least is far from a pivot that both have.

    Jaccard distance is a metric, so the other is nearly as far from the pivot. Those
    documents are few enough to rank all their tokens, rarest first, for the prefix filter.
    """
    edge = 2 * NEAR_PERCENT / (100 + NEAR_PERCENT) - (100 - percent) / 100 - 1e-6
    some = differences.filter(F.col("apart") >= edge).select("doc_id", "n", "component").distinct()
    sets = profiles.select("id", "tokens")
    tokens = some.join(sets, F.col("doc_id") == F.col("id")).select(
        "doc_id", "n", "component", F.explode("tokens").alias("token")
    )
    tokens = store(tokens, "far-tokens")
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("documents"))
    shared = tokens.join(counts.filter("documents > 1"), "token")
    own = Window.partitionBy("doc_id")
    rank = (
        F.col("n")
        - F.count(F.lit(1)).over(own)
        + F.row_number().over(own.orderBy("documents", "token"))
    )
    prefix = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    ranked = store(
        shared.withColumn("rank", rank).filter(F.col("rank") <= prefix).drop("rank", "documents"),
        "far-prefixes",
    )
    other = ranked.select(
        "token",
        F.col("doc_id").alias("o"),
        F.col("n").alias("m"),
        F.col("component").alias("other"),
    )
    met = ranked.join(other, "token").filter(
        (F.col("component") != F.col("other"))
        & (F.col("doc_id") < F.col("o"))
        & _long_enough(percent)
    )
    return met.select(*_ordered("doc_id", "o"))


def _profiles(docs: DataFrame, ids: DataFrame, words: int, percent: int) -> DataFrame:
    """Whole sets of some documents, with their prefixes under the further orders.

    Each further order ranks the tokens by their product with an odd number.
    """
    turns = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sets in _lower_sets(batch.column(1), words):
                prefixes: list[list[np.ndarray]] = [[], []]
                for own in sets:
                    p = _prefix(len(own), percent) if len(own) else 0
                    for k, turn in enumerate(turns):
                        prefixes[k].append(np.sort(own * turn)[:p].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[rows],
                        pa.array([len(s) for s in sets], pa.int32()),
                        *(list_column(p, pa.int64()) for p in prefixes),
                        list_column([s.view(np.int64) for s in sets], pa.int64()),
                    ],
                    ["id", "n", "second", "third", "tokens"],
                )

    wanted = docs.join(bounded_broadcast(ids, 8), docs["doc_id"] == ids["id"], "left_semi")
    schema = "id long, n int, second array<long>, third array<long>, tokens array<long>"
    return wanted.select(F.col("doc_id").cast("long"), "text").mapInArrow(compute, schema)


def _ids(pairs: DataFrame, a: str, b: str) -> DataFrame:
    both = pairs.select(F.col(a).alias("id")).union(pairs.select(b))
    return store(both.distinct(), "candidate-ids")


def _verified(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share prefix tokens under all orders and are similar enough."""
    brief = profiles.select("id", "second", "third")
    a, b = brief.alias("x"), brief.alias("y")
    passed = (
        pairs.join(a, F.col("a") == F.col("x.id"))
        .join(b, F.col("b") == F.col("y.id"))
        .filter(
            F.arrays_overlap("x.second", "y.second") & F.arrays_overlap("x.third", "y.third")
        )
        .select("a", "b")
    )
    passed = store(passed, "candidates-passed")
    sets = profiles.select("id", "n", "tokens")
    a, b = sets.alias("x"), sets.alias("y")
    common = F.size(F.array_intersect("x.tokens", "y.tokens"))
    checked = (
        passed.join(a, F.col("a") == F.col("x.id"))
        .join(b, F.col("b") == F.col("y.id"))
        .select("a", "b", (F.col("x.n") + F.col("y.n")).alias("total"), common.alias("common"))
    )
    similar = 100 * F.col("common") >= percent * (F.col("total") - F.col("common"))
    return store(checked.filter(similar).select("a", "b"), "links")


def _links(docs: DataFrame, entries: DataFrame, words: int, percent: int) -> DataFrame:
    """Components of the documents that any link joins."""
    posted = store(_posted(entries), "postings")
    star = posted.filter(_long_enough(percent)).select(*_ordered("doc_id", "pivot")).distinct()
    star = store(star, "candidates")
    profiles = _profiles(docs, _ids(star, "a", "b"), words, percent)
    links = _verified(star, store(profiles, "profiles"), percent)
    components = connected_components(links)

    postings = store(_open_postings(posted, components), "open-postings")
    groups = postings.select("pivot", "m", "doc_id", "n", "component").distinct()
    groups = store(groups, "pivot-groups")
    profiles = _profiles(docs, _ids(groups, "doc_id", "pivot"), words, percent)
    profiles = store(profiles, "profiles")
    differences = store(_differences(groups, profiles), "differences")
    rest = _near_pairs(differences, percent).union(_far_pairs(differences, profiles, percent))
    rest = store(rest.distinct(), "candidates")
    more = _verified(rest, profiles, percent)
    if not more.limit(1).collect():
        return components
    return connected_components(links.union(more))


def jaccard_components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    Documents link when their sets of ``words``-word shingles have a Jaccard similarity of
    ``percent`` in a hundred or more; ``component_id`` is the smallest doc_id reachable.
    """
    docs = docs.select("doc_id", "text")
    # A class is to hold half again the longest prefix, so that most prefixes end in it.
    classes = max(2, int(100 / (1.5 * (100 - percent))))
    copies, distinct = _representatives(docs)
    tokens = store(_class_tokens(distinct, words, percent, classes), "class-tokens")
    entries = store(_prefix_tokens(tokens, percent), "prefix-tokens")
    components = _links(distinct, entries, words, percent)
    sizes = tokens.groupBy(F.col("doc_id").alias("rep")).agg(F.max("n").alias("n"))
    joined = components.select(F.col("node").alias("rep"), "component")
    known = sizes.join(joined, "rep", "left").select(
        "rep", "n", F.coalesce("component", "rep").alias("component")
    )
    known = store(known, "known")
    ids = docs.select("doc_id").join(copies, "doc_id", "left").select(
        "doc_id", F.coalesce("rep", "doc_id").alias("rep")
    )
    found = ids.join(known, "rep", "left")
    empty = F.col("n").isNull() | (F.col("n") == 0)
    return found.select(
        "doc_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those whose component has a smaller doc_id, all columns kept."""
    found = jaccard_components(docs, words, percent)
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    gone = bounded_broadcast(store(gone, "near-copies"), 8)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
