"""N-gram Jaccard join by grouped prefixes.

A document is the set of its distinct shingles of words; two are linked when their common shingles
are at least so many percent of all of both. Equal sets are one node. Sets that are linked share a
shingle among the first few in any one order of shingles: their prefixes. The order is by rising
frequency, so prefixes are made of rare shingles, and a shingle that only one set has can lead to
no partner at all. Nodes with the same prefix and size make a group; candidates are found between
groups and pass filters of size and of shingles without a partner; then the groups' members are
compared by their whole sets.

Only shingles picked by their hash are counted, a fixed part of all; short documents, which would
have too few of them, are counted whole. That is one order for short documents and one for long
ones, with enough overlap in size that every pair that can be linked meets in one of them. It
changes how many candidates there are, not which links are found.

Groups of many near copies are not compared pair by pair: all are compared with one of them first,
and the rest only where that leaves them in different components.

A null text, or one without words, has no shingles and is linked with nothing. Rows with equal ids
are told apart by their sets. A null id is in the component of its links but never gives its name;
a component without any id is named null. Repeated rows get equal results. Hashes have 64 bits, the
identity of a set 128.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import free_names, map_batches, small_side, written
from .components import components
from .words import SPACED, Splitter, bytes_of, pieces

WORDS, PERCENT = 3, 90

# Documents of so many shingles have enough of the picked ones.
LONG = 100

# Bits of a set's parity, by words of 64.
PARITY = 8

_U = np.uint64


class Shingles:
    """Cuts texts into sets of shingle hashes; keeps its splitter between calls."""

    def __init__(self, words: int):
        self.words, self.splitter = words, Splitter(SPACED, True)

    def __call__(self, texts: pa.Array):
        """The sorted distinct hashes of each text, in order."""
        data, offsets = bytes_of(texts)
        for low, high in pieces(offsets):
            words = self.splitter.split(data, offsets[low : high + 1])
            hashes, at = self.splitter.grams(words, self.words)
            first = np.searchsorted(at, words.first)
            for i in range(high - low):
                n = words.first[i + 1] - words.first[i]
                if n >= self.words:
                    yield np.unique(hashes[first[i] : first[i + 1]])
                elif n:
                    few = words._replace(
                        hash=words.hash[words.first[i] : words.first[i + 1]], first=np.array([0, n]))
                    yield self.splitter.grams(few, int(n))[0]
                else:
                    yield hashes[:0]


def _identity(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _parity(hashes: np.ndarray) -> np.ndarray:
    odd = np.bincount(((hashes >> _U(16)) % _U(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _needed(n: int, percent: int) -> int:
    """Shingles that a linked set has in common with one of n at least."""
    return -(-percent * n // 100)


def sets(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, size ``n``, identity ``sid``, ``parity``, counted shingles ``tokens`` and ``tail``.

    The lowest bit of a token tells the order it belongs to: 0 for that of short documents, 1 for
    that of long ones. The tail has the shingles that a long document's prefix needs beyond the
    picked ones.
    """
    every = max(1, 50 // (100 - percent)) if percent < 100 else 50
    short = (LONG - 1) * 100 // percent
    held: list[Shingles] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Shingles(words))
        sizes, ids, tokens, tails, parities = [], [], [], [], []
        for hashes in held[0](batch.column(1)):
            n = len(hashes)
            sizes.append(n)
            ids.append(_identity(hashes) if n else None)
            own, tail = [], hashes[:0]
            if n <= short:
                own.append(hashes & ~_U(1))
            if n >= LONG:
                picked = (hashes >> _U(8)) % _U(every) == 0
                own.append(hashes[picked] | _U(1))
                tail = hashes[~picked][: max(0, n - _needed(n, percent) + 1 - int(picked.sum()))] | _U(1)
            tokens.append(np.unique(np.concatenate(own)).view(np.int64) if n else hashes.view(np.int64))
            tails.append(tail.view(np.int64))
            parities.append(_parity(hashes))
        offsets = lambda parts: pa.array(np.concatenate(([0], np.cumsum([len(p) for p in parts]))), pa.int32())
        join = lambda parts: pa.ListArray.from_arrays(
            offsets(parts), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64()))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), join(parities), join(tokens), join(tails)],
            names=["doc_id", "n", "sid", "parity", "tokens", "tail"])

    picked = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_batches(picked, run, "doc_id long, n long, sid binary, parity array<long>, tokens array<long>, tail array<long>")


def _most_apart(n1: Column, n2: Column, percent: int) -> Column:
    """By how many shingles linked sets of these sizes may differ."""
    return n1 + n2 - 2 * F.ceil((n1 + n2) * F.lit(percent) / F.lit(100 + percent))


def _reach(n1: Column, n2: Column, u1: Column, u2: Column, percent: int) -> Column:
    """Whether sets of these sizes, with so many shingles that only one of them has, may be linked."""
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & (u1 + u2 <= _most_apart(n1, n2, percent))


def _near(p1: Column, p2: Column, n1: Column, n2: Column, percent: int) -> Column:
    """Whether sets with these parities may be linked."""
    bits = sum(F.bit_count(p1[i].bitwiseXOR(p2[i])) for i in range(PARITY))
    return bits <= _most_apart(n1, n2, percent)


def prefixes(nodes: DataFrame, percent: int) -> DataFrame:
    """``node``, ``n``, ``order``, ``alone`` (counted shingles no other set has) and ``prefix``,
    its shingles that others have too. Nodes whose prefix has none of them are left out."""
    tokens = nodes.select("node", F.explode("tokens").alias("h"))
    shared = written(tokens.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1"), "shared")
    back = tokens.join(shared, "h").select("node", "h", "df", F.col("h").bitwiseAND(1).alias("order"))
    found = back.groupBy("node", "order").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("found"))
    in_order = lambda k: F.size(F.filter("tokens", lambda t: t.bitwiseAND(1) == k))
    sizes = nodes.select("node", "n", F.explode(F.array(*[
        F.struct(F.lit(k).alias("order"), in_order(k).alias("m"), (F.col("tail") if k else F.slice("tail", 1, 0)).alias("tail"))
        for k in (0, 1)])).alias("o")).select("node", "n", F.col("o.order").cast("long").alias("order"), "o.m", "o.tail").filter("m > 0")
    length = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / F.lit(100)) + 1
    joined = sizes.join(found, ["node", "order"], "left")
    alone = F.col("m") - F.when(F.col("found").isNull(), 0).otherwise(F.size("found"))
    own = F.when(F.col("found").isNotNull() & (length > alone), F.transform(
        F.slice("found", F.lit(1), F.greatest(length - alone, F.lit(1)).cast("int")), lambda x: x["h"]))
    prefix = F.concat(F.coalesce(own, F.array().cast("array<long>")), "tail")
    return written(joined.select("node", "order", "n", alone.cast("long").alias("alone"), prefix.alias("prefix")).filter(
        F.size("prefix") > 0), "prefixes")


def _groups(prefix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of nodes with one prefix and size, and their members."""
    solo = F.when(F.col("alone") > 0, F.col("node"))  # a shingle of its own is part of the prefix
    keyed = prefix.withColumn("key", F.sha2(F.concat_ws(",", F.col("prefix").cast("array<string>"), solo.cast("string"), F.col("order"), F.col("n")), 256))
    groups = written(keyed.groupBy("key").agg(
        F.min("node").alias("gid"), *[F.first(c).alias(c) for c in ("order", "n", "alone", "prefix")]), "groups")
    members = written(keyed.select("key", "node").join(groups.select("key", "gid"), "key").select("gid", "node"), "members")
    return groups.drop("key"), members


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int, text: str, doc_id: str) -> DataFrame:
    """Those pairs of nodes (a, b) that are linked, told by their whole sets."""
    pairs = written(pairs, "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(nodes.select("node", "doc", "sid").join(wanted, "node"), "wanted")
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    ids = written(wanted.select(F.col("doc").alias("id")).distinct(), "wanted")
    texts = own.join(small_side(ids), own["doc_id"].eqNullSafe(F.col("id")), "left_semi").select("text")
    held: list[Shingles] = []

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(Shingles(words))
        found = [(_identity(h), h.tobytes()) for h in held[0](batch.column(0)) if len(h)]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], names=["sid", "hashes"])

    def compared(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for one, two in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(v.as_buffer(), dtype=_U) for v in (one, two))
            both = len(x) + len(y) - len(np.union1d(x, y))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        return batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    read = map_batches(texts, whole, "sid binary, hashes binary").join(small_side(wanted.select("sid", "node")), "sid")
    full = written(read.select("node", "hashes"), "whole-sets")
    first = pairs.join(full.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b")
    rows = first.join(full.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a").select("a", "b", "ha", "hb")
    return written(map_batches(rows, compared, "a long, b long").distinct(), "links")


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members, links and labels of the join.

    Members: ``doc_id``, ``n_shingles`` and ``node`` of every row (null without shingles). Links:
    pairs of nodes (a, b), enough of all links to tell the components. Labels: ``node`` and
    ``label`` of every node with a link.
    """
    table = written(sets(docs, words, percent, text, doc_id), "sets")
    by_set = table.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("doc"))
    several = written(by_set.groupBy("doc").agg(F.count("*").alias("c")).filter("c > 1").select("doc"), "clashes")
    by_set = by_set.join(small_side(several.withColumn("odd", F.lit(1))), "doc", "left")
    named = written(by_set.select("sid", "doc", F.when(F.col("doc").isNull() | F.col("odd").isNotNull(), F.xxhash64("sid")).otherwise(
        F.col("doc")).alias("node"), (F.col("doc").isNull() | F.col("odd").isNotNull()).alias("hashed")), "nodes")
    # Copies of a set, but the first one, are left out by their ids, so the shingles need not move.
    members = table.select("doc_id", F.col("n").alias("n_shingles"), "sid").join(named, "sid", "left")
    later = written(members.filter("sid IS NOT NULL AND NOT doc_id <=> doc").select(
        F.col("doc_id").alias("i"), F.col("sid").alias("s")).distinct(), "copies")
    odd = written(named.filter("hashed").select(F.col("sid").alias("o"), F.col("node").alias("named")), "odd")
    firsts = table.filter("n > 0").join(
        small_side(later), F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("sid") == F.col("s")), "left_anti")
    firsts = firsts.join(small_side(odd), F.col("sid") == F.col("o"), "left")
    nodes = firsts.select(
        F.coalesce("named", "doc_id").alias("node"), F.col("doc_id").alias("doc"), "sid", "n", "parity", "tokens", "tail")

    prefix = prefixes(nodes, percent)
    groups, inside = _groups(prefix)
    postings = groups.select("gid", "order", "n", "alone", F.explode("prefix").alias("h"))
    # A hub for every shingle and band of sizes, and the first member of every group.
    band = F.floor(F.log("n") / F.lit(math.log(100 / min(percent, 99)))).cast("int")
    banded = postings.withColumn("band", band)
    hubs = written(banded.groupBy("h", "band").agg(F.min(F.struct("alone", "gid", "n")).alias("hub"), F.count("*").alias("c")).filter(
        "c > 1").select("h", "band", F.col("hub.alone").alias("hub_alone"), F.col("hub.gid").alias("hub"), F.col("hub.n").alias("hub_n")), "hubs")
    star = banded.join(hubs, ["h", "band"]).filter(
        (F.col("gid") != F.col("hub")) & _reach(F.col("n"), F.col("hub_n"), F.col("alone"), F.col("hub_alone"), percent)
    ).select(F.least("gid", "hub").alias("a"), F.greatest("gid", "hub").alias("b"))
    within = inside.filter("gid <> node").select(F.least("gid", "node").alias("a"), F.greatest("gid", "node").alias("b"))
    tried = written(star.union(within).distinct(), "tried")
    links = _verified(tried, nodes, docs, words, percent, text, doc_id)
    labels = components(links)

    # What is left to compare: groups that share a shingle and are not all in one component.
    known = nodes.select("node", "parity").dropDuplicates(["node"])
    placed = written(inside.join(labels, "node", "left").join(known, "node").select(
        "gid", "node", F.coalesce("label", "node").alias("label"), "parity"), "placed")
    spread = written(placed.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high")), "spread")
    labelled = postings.join(spread, "gid")
    # A shingle is open if it is in several components and two of its groups can be near enough.
    apart = _most_apart(F.col("n"), F.floor(F.col("n") * 100 / F.lit(percent)), percent)
    ends = written(labelled.groupBy("h").agg(F.min("low").alias("l"), F.max("high").alias("r"), F.min("alone").alias("fewest")).filter(
        "l <> r").select("h", "fewest"), "open")
    active = labelled.join(ends, "h").filter(F.col("alone") + F.col("fewest") <= apart)
    active = written(active.select("gid", "h", "n", "alone"), "active")
    # Their members, of which only pairs that pass all filters leave the join.
    expanded = written(active.join(placed, "gid").select("h", "node", "label", "n", "alone", "parity"), "expanded")
    one, two = (expanded.select(*[F.col(c).alias(f"{c}{i}") for c in expanded.columns]) for i in (1, 2))
    pair = (F.col("h1") == F.col("h2")) & (F.col("node1") < F.col("node2")) & (F.col("label1") != F.col("label2"))
    reach = _reach(F.col("n1"), F.col("n2"), F.col("alone1"), F.col("alone2"), percent)
    near = _near(F.col("parity1"), F.col("parity2"), F.col("n1"), F.col("n2"), percent)
    expanded = one.join(two, pair & reach & near).select(F.col("node1").alias("a"), F.col("node2").alias("b")).distinct()
    rest = written(expanded.join(tried, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = _verified(rest, nodes, docs, words, percent, text, doc_id)
        links = written(links.union(more), "links")
        labels = components(links)
    return members.select("doc_id", "n_shingles", "node"), links, labels


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id that links lead to."""
    members, _, labels = join(docs, words, percent, text, doc_id)
    placed = written(members.join(labels, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("label", "node").alias("label")), "members")
    names = written(placed.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id")), "names")
    named = placed.filter("label IS NOT NULL").join(names, "label")
    alone = placed.filter("label IS NULL").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return named.select(*columns).unionByName(alone.select(*columns))


def deduplicated(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Documents, with their own columns, of which one of each component stays: that with the smallest id.

    Of rows that share id and text one stays. Where rows share an id but not the text, they stay or
    go together. Documents without shingles, and rows without an id, stay.
    """
    near = near_duplicates(docs, words, percent, text, doc_id)
    gone = ~F.coalesce(F.col("component_id").eqNullSafe(F.col("doc_id")), F.lit(False))
    by_id = written(near.groupBy("doc_id").agg(F.bool_and(gone).alias("gone"), F.count("*").alias("c")), "stays")
    out, again = free_names(docs, "__out", "__again")
    several = by_id.filter("c > 1 AND (NOT gone OR doc_id IS NULL)").select(F.col("doc_id").alias(again))
    drop = written(by_id.filter("gone AND doc_id IS NOT NULL").select(F.col("doc_id").alias(out)), "gone")
    kept = docs.join(small_side(drop), F.col(f"`{doc_id}`") == F.col(out), "left_anti")
    several = written(several, "several")
    if several.isEmpty():
        return kept
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(again))
    single = kept.join(small_side(several), same, "left_anti")
    return single.unionByName(kept.join(small_side(several), same, "left_semi").dropDuplicates([doc_id, text]))
