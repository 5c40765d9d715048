"""Similarity join on word shingles by adaptive multi-match prefixes.

Shingles have a global order: those that very many documents contain come
last, the most frequent of them at the end, otherwise by hash. If two sets overlap enough, then for every ``l`` the first
``n - t + l`` shingles of both share at least ``l``, where ``t`` is the least overlap a
document of ``n`` shingles can be linked with. ``l`` is chosen per document: the more
candidates its prefix is estimated to bring, the longer the prefix and the more
common shingles a candidate needs before it is verified.

Documents with equal sets are one class. The first round verifies each class
against one leader per shingle and size band, which joins groups of near copies
without looking at their pairs. The second round takes all further candidate
pairs of classes that are not connected yet. Links are verified on whole sets.

Many near copies of one text often lie too far from each other for any leader, yet share most of
each prefix. The classes of a crowded shingle are therefore also compared with a
hub, a class whose shingles many others have, and keep what they do not have in common with it.
Two classes of one hub differ by the difference of these two sets. So either they
share enough of them, and a prefix join on these sets, whose elements are rare, finds the pair; or both are linked
with the hub. The second round leaves out pairs of one hub.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import col
from ..plans.storage import release
from .arrays import Words, mixed, run_hashes, segments, slices
from .common import concluded, saved, small
from .components import components

SHINGLE = 3
PERCENT = 90
COUNTED = 4  # shingles in the first quarter of the hash space are counted in all documents, the others where a prefix reaches them
FREQUENT = 16  # shingles of more documents come last
MOST_FREQUENT = 1_000_000  # so many of them at most in either part of the hash space; the others keep their place by hash
LONGEST = 12  # largest l
CHEAP = 64  # estimated candidates that need no longer prefix
KEYS_BROADCAST = 1_000_000
CROWD = 16  # classes with one shingle that are compared with a hub
HALF = 50  # percent of similarity to the hub, from which a class keeps its difference
CUT = 16  # low bits of a hash that filters and orders leave out: fewer bytes to shuffle, a rare clash only costs candidates


class Shingles:
    """Distinct shingles of some texts, by text and hash: ``owner`` and ``value``, and each text's number of them."""

    def __init__(self, texts: pa.Array, size: int):
        words = Words(texts, lower=True)
        n, hashes = np.diff(words.first), words.word_hashes()
        runs = run_hashes(hashes, size)
        at = np.arange(len(runs))
        owner, _ = segments(n)
        at = at[at + size <= words.first[1:][owner[: len(at)]]]
        short = np.flatnonzero((n > 0) & (n < size))  # the whole text is their one shingle
        whole = np.array([self._whole(hashes[a:b]) for a, b in zip(words.first[short], words.first[short + 1])], np.uint64)
        value, owner = np.concatenate([runs[at], whole]), np.concatenate([owner[at], short])
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        self.value, self.owner = value[new], owner[new]
        self.count = np.bincount(self.owner, minlength=len(n))
        self.ends = np.concatenate([[0], np.cumsum(self.count)])

    @staticmethod
    def _whole(hashes: np.ndarray) -> int:
        out = 1
        for h in hashes.tolist():
            out = (out * 0x9E3779B97F4A7C15 + h) % (1 << 64)
        return out

    def classes(self) -> np.ndarray:
        """Equal for equal sets."""
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(self.value ^ np.uint64(0x5851F42D4C957F2D)))])
        return mixed((sums[self.ends[1:]] - sums[self.ends[:-1]]) ^ self.count.astype(np.uint64)).view(np.int64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _sets(rows: DataFrame, size: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = Shingles(part.column("text"), size)
                columns = [part.column("__key"), part.column("__id"), pa.array(found.count), pa.array(found.classes())]
                yield pa.RecordBatch.from_arrays(columns, ["__key", "__id", "n", "class"])

    return rows.mapInArrow(find, f"__key long, __id {rows.schema['__id'].dataType.simpleString()}, n long, class long")


def prefix_lengths(n: np.ndarray, cost: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Needed matches ``l`` and prefix length of documents with ``n`` shingles."""
    needed = 1 + np.ceil(np.log2(np.maximum(cost, CHEAP) / CHEAP)).astype(np.int64)
    least = -(-percent * n // 100)
    needed = np.minimum(np.minimum(needed, LONGEST), np.maximum(least, 1))
    return needed, n - least + needed


def _ordered(sets: Shingles, frequent: tuple[np.ndarray, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingles in global order within their documents, which of them are in the prefix, and each document's ``l``."""
    hot, documents = frequent
    weight = np.zeros(len(sets.value))
    if len(hot):
        upper = sets.value >> np.uint64(CUT)
        at = np.minimum(np.searchsorted(hot, upper), len(hot) - 1)
        weight = np.where(hot[at] == upper, documents[at], 0)
    order = np.lexsort((weight, sets.owner))  # stable: by hash among equals
    owner, place = sets.owner, np.arange(len(order)) - sets.ends[sets.owner]
    base = sets.count - -(-percent * sets.count // 100) + 1
    cost = np.bincount(owner, np.where(place < base[owner], weight[order], 0), len(sets.count))
    needed, length = prefix_lengths(sets.count, cost, percent)
    return order, place < length[owner], needed


def _most_frequent(rows: DataFrame, size: int, wanted: Callable[[Shingles], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of the ``wanted`` shingles of each document, those that more than ``FREQUENT`` ask for: sorted upper bits, and numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, n = np.unique(wanted(Shingles(part.column("text"), size)) >> np.uint64(CUT), return_counts=True)
                yield pa.RecordBatch.from_arrays([_signed(found), pa.array(n)], ["shingle", "n"])

    counted = rows.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    table = saved(counted.where(F.col("n") > FREQUENT), "frequent")
    if table.count() > MOST_FREQUENT:
        table = table.orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT)
    found = table.toArrow()
    values = np.asarray(found["shingle"].combine_chunks()).view(np.uint64) if found.num_rows else np.zeros(0, np.uint64)
    order = np.argsort(values)
    counts = np.asarray(found["n"].combine_chunks()) if found.num_rows else np.zeros(0, np.int64)
    return values[order], counts[order]


def _frequent(rows: DataFrame, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted upper bits of frequent shingles, and their numbers of documents.

    Most prefixes end within the low part of the hash space, whose shingles are all
    counted. The other shingles are counted among the documents whose prefix goes beyond
    it: only from these can they enter the index.
    """
    limit = np.uint64((1 << 64) // COUNTED)
    low = _most_frequent(rows, size, lambda sets: sets.value[sets.value < limit])
    shared = rows.sparkSession.sparkContext.broadcast(low)  # at most MOST_FREQUENT shingles

    def beyond(sets: Shingles) -> np.ndarray:
        order, inside, _ = _ordered(sets, shared.value, percent)
        deep = np.bincount(sets.owner, inside & (sets.value[order] >= limit), len(sets.count)) > 0
        return sets.value[(sets.value >= limit) & deep[sets.owner]]

    high = _most_frequent(rows, size, beyond)
    shared.unpersist()
    return np.concatenate([low[0], high[0]]), np.concatenate([low[1], high[1]])


def _index(rows: DataFrame, size: int, percent: int, shared: Broadcast) -> DataFrame:
    """``shingle, class, n, needed``: the prefixes of all documents, from the broadcast frequent shingles."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = Shingles(part.column("text"), size)
                order, take, needed = _ordered(sets, shared.value, percent)
                who = sets.owner[take]
                yield pa.RecordBatch.from_arrays(
                    [_signed(sets.value[order][take]), pa.array(sets.classes()[who]), pa.array(sets.count[who]), pa.array(needed[who])],
                    ["shingle", "class", "n", "needed"],
                )

    return rows.select("text").mapInArrow(find, "shingle long, class long, n long, needed long")


def _compared(rows: DataFrame, reps: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs of classes ``a, b, hub`` that are similar enough, with their numbers of shingles ``na, nb``.

    Where ``b`` is the hub of ``a``, pairs that share half of their shingles stay as well, and ``apart`` lists the
    shingles that one of both has. The sets of ``a`` go to ``b``; many followers of one class arrive as rows of their own.
    """
    to = F.struct("b", "hub")
    ends = pairs.select(F.col("a").alias("class"), to.alias("to"), F.lit(False).alias("leads")).unionByName(
        pairs.select(F.col("b").alias("class"), F.lit(None).cast("struct<b:long,hub:boolean>").alias("to"), F.lit(True).alias("leads")).distinct()
    )
    wanted = ends.groupBy("class").agg(F.collect_list("to").alias("to"), F.max("leads").alias("leads")).join(reps, "class")
    wanted = saved(wanted.select("__key", "class", "to", "leads"), "wanted")
    few = wanted.count() <= KEYS_BROADCAST

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = Shingles(part.column("text"), size)
                data = [sets.value[a:b].tobytes() for a, b in zip(sets.ends[:-1], sets.ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("class", "to", "leads")), pa.array(data, pa.binary())], ["class", "to", "leads", "shingles"]
                )

    def sets(some: DataFrame) -> DataFrame:
        found = rows.select("__key", "text").join(F.broadcast(some) if few else some, "__key").select("class", "to", "leads", "text")
        return found.mapInArrow(find, "class long, to array<struct<b:long,hub:boolean>>, leads boolean, shingles binary")

    sending, leading = F.size("to") > 0, F.col("leads")
    if few:  # the texts are read twice, and hardly any set is made twice
        senders, leaders = sets(wanted.where(sending)), sets(wanted.where(leading))
    else:  # the texts are shuffled once
        made = saved(sets(wanted), "sets")
        senders, leaders = made.where(sending), made.where(leading)
    sent = senders.select(F.col("class").alias("a"), F.explode("to").alias("to"), F.col("shingles").alias("own")).select("a", "to.*", "own")
    leaders = leaders.select(F.col("class").alias("b"), F.col("shingles").alias("other")).hint("merge")  # one plan at every size

    @F.arrow_udf("array<long>")
    def compare(own: pa.Array, other: pa.Array, hub: pa.Array) -> pa.Array:
        out = []
        for x, y, near in zip(own, other, hub.to_pylist()):
            x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
            apart = np.setxor1d(x, y, assume_unique=True)
            whole = len(x) + len(y)  # twice the common shingles, and those apart
            least = min(percent, HALF) if near else percent
            enough = 100 * (whole - len(apart)) >= least * (whole + len(apart))
            out.append((apart.view(np.int64) if near else []) if enough else None)
        return pa.array(out, pa.list_(pa.int64()))

    compare = compare.asNondeterministic()  # else the filter below compares again, in Python processes of its own
    number = lambda name: (F.length(name) / 8).cast("long")
    met = sent.join(leaders, "b").select("a", "b", "hub", number("own").alias("na"), number("other").alias("nb"), compare("own", "other", "hub").alias("apart"))
    found = saved(met.where("apart IS NOT NULL"), "compared")
    release(rows.sparkSession)  # the keys that were broadcast
    return found


def _similar(compared: DataFrame, percent: int) -> DataFrame:
    whole, apart = F.col("na") + F.col("nb"), F.size("apart")
    return compared.where(~F.col("hub") | (100 * (whole - apart) >= percent * (whole + apart))).select("a", "b").distinct()


def _hubs(index: DataFrame, percent: int) -> DataFrame:
    """``a, b``: each class that has a crowded shingle in its prefix, and the hub it meets most, itself perhaps.

    The hub of a shingle is the class whose prefix, in the mean, most others share.
    """
    crowded = index.groupBy("shingle").agg(F.count("*").alias("k")).where(F.col("k") >= CROWD)
    rows = saved(index.join(small(saved(crowded, "crowded"), KEYS_BROADCAST), "shingle"), "crowded-index")
    length = F.first(F.col("n") - F.ceil(percent * F.col("n") / 100 - 1e-6) + F.col("needed"))
    score = rows.groupBy("class").agg((F.sum(F.floor(1000 * F.log2("k"))) / length).alias("score"))
    hub = rows.join(score, "class").groupBy("shingle").agg(F.max(F.struct("score", "class")).getField("class").alias("hub"))
    met = rows.join(hub, "shingle").groupBy("class", "hub").agg(F.count("*").alias("common"))
    most = met.groupBy("class").agg(F.max(F.struct("common", "hub")).getField("hub").alias("b"))
    return saved(most.select(F.col("class").alias("a"), "b"), "hubs")


def _around(compared: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs ``a, b`` of classes with one hub that are not connected yet.

    With ``S`` the most that linked sets differ by, sets that differ from the hub by ``x`` and ``y`` elements share at least
    ``(x + y - S) / 2`` of these. If that is no positive number, both are linked with the hub.
    """
    far = compared.where("hub").select(F.col("a").alias("class"), F.col("b").alias("hub"), F.col("na").alias("n"), "apart")
    far = far.join(known, F.col("class") == F.col("node"), "left").withColumn("component", F.coalesce("component", "class"))
    each = far.select("class", "hub", "n", "component", F.size("apart").alias("d"), F.explode("apart").alias("element"))
    shared = each.groupBy("hub", "element").agg(F.count("*").alias("k")).where("k > 1")
    mine = Window.partitionBy("hub", "class")  # at most the shingles of two documents
    alone = F.col("d") - F.count("*").over(mine)  # elements no other class has come first
    each = each.join(shared, ["hub", "element"]).withColumn("place", alone + F.row_number().over(mine.orderBy("k", "element")))
    most = (100 - percent) * F.col("n") / percent  # no linked set differs by more
    each = saved(each.where(F.col("place") <= F.floor(most + 1e-6) + 1), "around")
    side = lambda end: [F.col(c).alias(c + end) for c in ("class", "n", "component", "d", "place")]
    left = each.where(F.col("place") <= F.floor(most / 2 + 1e-6) + 1).select("hub", "element", *side("_a"))
    right = each.select("hub", "element", *side("_b"))
    differ = F.floor((100 - percent) * (F.col("n_a") + F.col("n_b")) / (100 + percent) + 1e-6)
    common = F.greatest(F.lit(1), F.ceil((F.col("d_a") + F.col("d_b") - differ) / 2))
    closer = F.struct("d_a", "class_a") < F.struct(F.col("d_b").alias("d_a"), F.col("class_b").alias("class_a"))
    inside = (F.col("place_a") <= F.col("d_a") - common + 1) & (F.col("place_b") <= F.col("d_b") - common + 1)
    met = left.join(right, ["hub", "element"]).where(closer & inside & _fits("n_a", "n_b", percent) & F.expr("component_a <> component_b"))
    return met.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()


def _band(n: str, percent: int):
    return F.floor(F.ln(n) / np.log(100 / percent))


def _fits(a: str, b: str, percent: int):
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def _least_common(na: str, nb: str, la: str, lb: str, percent: int):
    """Fewest shingles the prefixes of a linked pair share.

    Up to the end of the prefix that ends first, all common shingles are in both
    prefixes; beyond it, at most that document's other shingles can be common.
    """
    overlap = F.ceil(percent * (F.col(na) + F.col(nb)) / (100 + percent) - 1e-6)
    other = lambda n, needed: F.ceil(percent * F.col(n) / 100 - 1e-6) - F.col(needed)
    return F.greatest(F.least(la, lb), overlap - F.greatest(other(na, la), other(nb, lb)))


def _candidates(met: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` that meet in enough shingles, from a row per common shingle; ``b`` is the smaller set."""
    fits = met.where(_fits("na", "nb", percent)).withColumn("least", _least_common("na", "nb", "la", "lb", percent))
    ends = [F.struct("na", "a"), F.struct(F.col("nb").alias("na"), F.col("b").alias("a"))]
    pair = [F.greatest(*ends).getField("a").alias("a"), F.least(*ends).getField("a").alias("b")]
    counted = fits.groupBy(*pair).agg(F.count("*").alias("common"), F.max("least").alias("least"))
    return counted.where("common >= least").select("a", "b")


def _shared_index(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """The prefixes with their size ``band``, without shingles that one class alone has in its prefix."""
    shared = rows.sparkSession.sparkContext.broadcast(_frequent(rows, size, percent))  # at most 2 * MOST_FREQUENT shingles
    index = saved(_index(rows, size, percent, shared), "index")
    shared.unpersist()
    upper = F.shiftrightunsigned("shingle", CUT)
    kind = F.shiftrightunsigned("class", CUT)
    several = index.groupBy(upper.alias("upper")).agg(F.min(kind).alias("x"), F.max(kind).alias("y")).where("x <> y").select("upper")
    several = small(saved(several, "shared"), KEYS_BROADCAST)
    index = index.join(several, upper == several["upper"], "left_semi").distinct()
    return index.withColumn("band", _band("n", percent))


def class_links(rows: DataFrame, reps: DataFrame, size: int, percent: int) -> DataFrame:
    """Components of classes: ``node, component``, for all classes that have a link to another."""
    index = concluded("shared-index", _shared_index, rows, size, percent)
    leader = index.groupBy("shingle", "band").agg(F.min(F.struct("n", "class", "needed")).alias("leader"))
    led = index.join(leader, ["shingle", "band"]).select(
        F.col("class").alias("a"), F.col("n").alias("na"), F.col("needed").alias("la"),
        F.col("leader.class").alias("b"), F.col("leader.n").alias("nb"), F.col("leader.needed").alias("lb"),
    )
    first = saved(_candidates(led.where("a <> b"), percent), "first-pairs")
    hubs = _hubs(index, percent)
    pairs = first.withColumn("hub", F.lit(False)).unionByName(hubs.where("a <> b").withColumn("hub", F.lit(True)))
    compared = _compared(rows, reps, pairs.groupBy("a", "b").agg(F.max("hub").alias("hub")), size, percent)
    links = _similar(compared, percent)
    known = small(concluded("components", components, links), KEYS_BROADCAST)

    near = compared.where("hub").select(F.col("a").alias("member"), F.col("b").alias("center"))
    near = near.unionByName(hubs.where("a = b").toDF("member", "center"))
    near = small(saved(near, "near"), KEYS_BROADCAST)
    marked = index.join(known, index["class"] == known["node"], "left").withColumn("component", F.coalesce("component", "class")).drop("node")
    marked = marked.join(near, F.col("class") == F.col("member"), "left")
    marked = marked.withColumn("kind", F.struct(F.col("center").isNotNull().alias("near"), F.coalesce("center", "component").alias("of")))
    sizes = marked.groupBy("shingle", "kind").agg(F.count("*").alias("k"))
    major = sizes.groupBy("shingle").agg(F.max(F.struct("k", "kind")).alias("major"), F.count("*").alias("kinds"))
    major = small(saved(major.where("kinds > 1").select("shingle", F.col("major.kind").alias("major")), "major"), KEYS_BROADCAST)
    open_rows = saved(marked.join(major, "shingle"), "open")
    left = open_rows.where("kind <> major").select(
        "shingle", F.col("class").alias("a"), F.col("n").alias("na"), F.col("needed").alias("la"), F.col("component").alias("ca"),
        F.col("kind").alias("ka"), F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"),
    )
    right = open_rows.select(
        "shingle", "band", F.col("class").alias("b"), F.col("n").alias("nb"), F.col("needed").alias("lb"),
        F.col("component").alias("cb"), F.col("kind").alias("kb"), "major",
    )
    met = left.join(right, ["shingle", "band"]).where("ka <> kb AND ca <> cb AND (kb = major OR a < b)")
    second = _candidates(met, percent).join(first, ["a", "b"], "left_anti").unionByName(_around(compared, known, percent))
    second = saved(second.distinct().withColumn("hub", F.lit(False)), "second-pairs")
    more = _similar(_compared(rows, reps, second, size, percent), percent)
    return components(links.unionByName(more))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key, text, and a hash of both that stands for the row."""
    return docs.select(
        col(key).alias("__id"), F.coalesce(col(text), F.lit("")).alias("text"), F.xxhash64(col(key), col(text)).alias("__key")
    )


def _documents(rows: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """All documents with ``n``, and ``class, component`` of those that have shingles."""
    sets = saved(_sets(rows, size), "documents")
    reps = saved(sets.where("n > 0").groupBy("class").agg(F.min("__key").alias("__key")), "classes")
    found = concluded("class-links", class_links, rows, reps, size, percent)
    joined = reps.select("class").join(found, F.col("class") == F.col("node"), "left")
    return sets, joined.select("class", F.coalesce("component", "class").alias("component"))


def near_copies(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``key, n_shingles, component_id``, the smallest key reachable by links.

    A missing or empty text has no shingles and is linked with nothing; equal
    rows are linked with each other; a missing key counts only where a component has no other.
    """
    sets, classes = _documents(_rows(docs, key, text), size, percent)
    some = sets.where("n > 0")
    least = some.groupBy("class").agg(F.min("__id").alias("least")).join(classes, "class")
    whole = least.groupBy("component").agg(F.min("least").alias("component_id"))
    table = least.select("class", "component").join(whole, "component").select("class", "component_id")
    out = some.join(table, "class").select(F.col("__id").alias(key), F.col("n").alias("n_shingles"), "component_id")
    none = sets.where("n = 0").select(F.col("__id").alias(key), F.col("n").alias("n_shingles"), F.col("__id").alias("component_id"))
    return out.unionByName(none)


def _fates(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """``__key, __stays`` of the documents that are not alone in their component."""
    sets, classes = _documents(rows, size, percent)
    some = sets.where("n > 0").join(classes, "class")
    best = F.min(F.struct(F.col("__id").isNull(), F.col("__id"), F.col("__key"))).getField("__key")
    groups = some.groupBy("component").agg(best.alias("best"), F.count("*").alias("rows")).where("rows > 1")
    return some.join(groups, "component").select("__key", (F.col("__key") == F.col("best")).alias("__stays")).distinct()


def drop_near_copies(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents, one of each component: the one with the smallest key, a missing key last.

    Columns may have any names, those used here included, and come back as they were.
    Only rows that stay for others are shuffled, to leave one of repeated rows.
    """
    fate = small(concluded("fates", _fates, _rows(docs, key, text), size, percent), KEYS_BROADCAST)
    whole = docs.select(F.struct("*").alias("__whole"), F.xxhash64(col(key), col(text)).alias("__key"))
    marked = whole.join(fate, "__key", "left")
    alone = marked.where("__stays IS NULL").select("__whole.*")
    return alone.unionAll(marked.where("__stays").dropDuplicates(["__key"]).select("__whole.*"))
