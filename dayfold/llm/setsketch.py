"""Near-duplicate components by SetSketch registers.

Every shingle of a document is the seed of a stream of arrivals: exponential waiting times, each
arrival at a register drawn by chance. A register holds the earliest arrival of all shingles, on a
scale of powers of ``BASE`` and truncated to one byte. Registers of a union are the larger ones of
its parts, so sketches can be merged; of two sets they are equal about as often as the sets have
shingles in common. ``BANDS`` bands of ``ROWS`` registers each are the keys under which documents
meet: two with a similarity of 0.85 miss each other in all of them with a chance of about 2e-7.

Candidates are estimated jointly: of which set more registers are larger, and how many are equal,
gives with the known sizes the likelihood of each similarity. A pair goes on unless the similarity
asked for is less likely than the best one by a factor of e**12.5 (five standard deviations). Links
are confirmed on the full sets.

Documents of one set are one node. In each bucket all members are first compared with its smallest
one of like size; then, in rounds, one more member of each bucket that is still in several components
is compared with those of the others, so that a family of near copies that drift apart becomes one
component at a cost in proportion to its size. Last come all pairs across components that still share
a bucket; of a bucket's largest component each member only meets those of the others. A pair leaves the
join if enough of its registers agree (five standard deviations below what is expected) and the parities
of its sets are near enough (which loses no link), and then goes through the likelihood. A family of very many documents that all are a little too far apart stays in as
many components, and costs the square of its size there.

A null text, or one without words, has no shingles and is linked with nothing. Rows with equal ids are
told apart by their sets, but kept or not alike where these are in one component. A null id never
names a component; a component without any id is named null and its rows are kept. Repeated rows get
equal results. Other columns are not looked at. An empty table gives none. Ids are whole numbers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import map_batches, written
from .components import components
from .jaccard import Shingles, _verified as verified
from .words import mix

WORDS, PERCENT = 3, 85

# Registers, and how they are banded; base and rate of their scale; the largest value.
REGISTERS, BANDS, ROWS = 128, 25, 5
BASE, RATE, TOP = 1.1, 20.0, 255

# Numbers that hold the registers of a sketch, seven in each.
LONGS = -(-REGISTERS // 7)

# Numbers that hold the parity of a set.
PARITY = 16

# Members of a bucket that meet in one cell, of each of its two sides.
CELL = 1024

# Pairs across components, for each member of a bucket, up to which no more members are tried first.
SPARSE = 1024

# Log likelihood by which the similarity asked for may fall behind the best one.
BEHIND = 12.5

# Documents and shingles that are sketched together.
TOGETHER, SHINGLES = 512, 1 << 17

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def sketch(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers of sets whose distinct hashes are ``hashes[first[i] : first[i + 1]]``, a row each."""
    n = len(first) - 1
    arrival = np.full(n * REGISTERS, np.inf)
    doc = np.repeat(np.arange(n), np.diff(first))
    seed, time = mix(hashes ^ _STEP), np.zeros(len(hashes))
    bound, step = np.full(n, np.inf), 0
    while len(seed):
        many = min(64, max(1, (1 << 16) // len(seed)))
        k = (np.arange(step + 1, step + many + 1).astype(_U) * _STEP)[None, :]
        drawn = mix(seed[:, None] + k)
        waits = -np.log1p(-(drawn >> _U(11)).astype(np.float64) * 2.0**-53) / REGISTERS
        times = np.cumsum(np.concatenate((time[:, None], waits), axis=1), axis=1)[:, 1:]
        at = doc[:, None] * REGISTERS + (drawn & _U(REGISTERS - 1)).astype(np.int64)
        early = times < bound[doc][:, None]
        np.minimum.at(arrival, at[early], times[early])
        bound = arrival.reshape(n, REGISTERS).max(axis=1)
        step, time = step + many, times[:, -1]
        going = time < bound[doc]
        seed, time, doc = seed[going], time[going], doc[going]
    with np.errstate(divide="ignore"):
        scale = np.floor(1 - (np.log(arrival) - math.log(RATE)) / math.log(BASE))
    return np.clip(scale, 0, TOP).astype(np.uint8).reshape(n, REGISTERS)


def likely(
    larger: np.ndarray, smaller: np.ndarray, n1: np.ndarray, n2: np.ndarray, percent: int, behind: float = BEHIND
) -> np.ndarray:
    """Whether sets may have the similarity, told by how many registers of the first are larger and smaller."""
    u, v = n1 / (n1 + n2), n2 / (n1 + n2)
    most = np.minimum(u, v) / np.maximum(u, v)
    grid = most[:, None] * np.linspace(0, 1, 65)[None, :]
    grid = np.concatenate((grid, np.minimum(most, percent / 100)[:, None]), axis=1)
    chance = lambda x: -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / math.log(BASE)
    up, down = chance(u[:, None] - v[:, None] * grid), chance(v[:, None] - u[:, None] * grid)
    log = lambda x: np.log(np.maximum(x, 1e-9))
    value = larger[:, None] * log(up) + smaller[:, None] * log(down) + (REGISTERS - larger - smaller)[:, None] * log(1 - up - down)
    asked = np.where(grid >= percent / 100 - 1e-12, value, -np.inf).max(axis=1)
    return asked >= value.max(axis=1) - behind


def packed(registers: np.ndarray) -> pa.Array:
    """Rows of registers as lists of numbers with seven registers each."""
    n = len(registers)
    room = np.zeros((n, LONGS, 8), dtype=np.uint8)
    room[:, :, :7] = np.pad(registers, ((0, 0), (0, 7 * LONGS - REGISTERS))).reshape(n, LONGS, 7)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * LONGS, pa.int32()), pa.array(room.view(np.int64).ravel()))


def _registers(column: pa.Array) -> np.ndarray:
    rows = column.flatten().to_numpy().reshape(-1, LONGS, 1).view(np.uint8)
    return rows[:, :, :7].reshape(-1, 7 * LONGS)[:, :REGISTERS]


def equal(one: Column, two: Column) -> Column:
    """In how many registers two packed sketches agree: bytes of their difference that are zero."""
    low, above = F.lit(0x7F7F7F7F7F7F7F), F.lit(-1 << 56)
    differ = [one[i].bitwiseXOR(two[i]) for i in range(LONGS)]
    # One bit is left of every byte that is zero; the eighth byte does not count.
    odd = [(x.bitwiseAND(low) + low).bitwiseOR(x).bitwiseOR(low).bitwiseOR(above) for x in differ]
    return sum((F.bit_count(F.bitwise_not(x)) for x in odd), F.lit(REGISTERS - 7 * LONGS))


def parity(hashes: np.ndarray) -> np.ndarray:
    """For each of some parts of all hashes whether the set has an odd number of them, as bits."""
    odd = np.bincount(((hashes >> _U(16)) % _U(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def within_reach(p1: Column, p2: Column, n1: Column, n2: Column, percent: int) -> Column:
    """Whether sets with these parities may be linked: every bit that differs is a shingle of one alone."""
    apart = n1 + n2 - 2 * F.ceil((n1 + n2) * F.lit(percent) / F.lit(100 + percent))
    return sum(F.bit_count(p1[i].bitwiseXOR(p2[i])) for i in range(PARITY)) <= apart


def at_least(percent: int, deviations: float) -> int:
    """Registers in which sets of this similarity agree at least, but for so many standard deviations."""
    most, j = (BASE - 1) / BASE, percent / 100
    loss = lambda x: -math.log1p(-x * most) / math.log(BASE)
    p = 1 - max(2 * loss((1 - j) / 2), loss((1 - j) / (1 + j)))
    return math.floor(REGISTERS * p - deviations * math.sqrt(REGISTERS * p * (1 - p)))


def sketches(docs: DataFrame, words: int = WORDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, size ``n`` of the set of shingles, its identity ``sid``, ``registers`` and ``parity``."""
    held: list[Shingles] = []

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(Shingles(words))
        sets, low, total = [], 0, 0

        def given() -> pa.RecordBatch:
            first = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)
            rows = sketch(np.concatenate(sets), first)
            return pa.RecordBatch.from_arrays([
                batch.column(0).slice(low, len(sets)), pa.array(np.diff(first)),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                packed(rows), pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sets) + 1) * PARITY, pa.int32()), pa.array(np.concatenate([parity(s) for s in sets])))],
                names=["doc_id", "n", "sid", "registers", "parity"])

        for own in held[0](batch.column(1)):
            sets.append(own)
            total += len(own)
            if len(sets) >= TOGETHER or total >= SHINGLES:
                yield given()
                low, sets, total = low + len(sets), [], 0
        if sets:
            yield given()

    picked = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_batches(picked, run, "doc_id long, n long, sid binary, registers array<long>, parity array<long>")


def _keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Keys of all bands of each node: the band's number and its registers in one number."""
    rows = _registers(batch.column(2))[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.int64)
    keys = np.broadcast_to(np.arange(BANDS), rows.shape[:2]).copy()
    for r in range(ROWS):
        keys = keys << 8 | rows[:, :, r]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * BANDS, pa.int32()), pa.array(keys.ravel()))
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["node", "n", "keys"])


def _like(n1: str, n2: str, percent: int):
    return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int, behind: float = BEHIND) -> DataFrame:
    """Those pairs (a, b) of nodes whose registers allow the similarity."""
    of = lambda end: nodes.select(F.col("node").alias(end), F.col("n").alias(f"n{end}"), F.col("registers").alias(f"r{end}"))
    rows = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "na", "nb", "ra", "rb")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not batch.num_rows:
            return batch.select(["a", "b"])
        one, two = _registers(batch.column(4)), _registers(batch.column(5))
        sizes = [batch.column(i).to_numpy().astype(np.float64) for i in (2, 3)]
        fits = likely((one > two).sum(axis=1), (one < two).sum(axis=1), *sizes, percent, behind)
        return batch.filter(pa.array(fits)).select(["a", "b"])

    return map_batches(rows, run, "a long, b long")


def _across(percent: int, near: int):
    """Pairs of two sides of a cell that may be linked; rows of a cell follow one another."""

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        side = rows.column("side").to_numpy()
        halves = []
        for s in (0, 1):
            half = rows.filter(pa.array(side == s)).combine_chunks()
            flat = lambda c: half.column(c).combine_chunks()
            halves.append((
                *(half.column(c).to_numpy() for c in ("node", "n", "label", "main")),
                _registers(flat("registers")), flat("parity").flatten().to_numpy().view(_U).reshape(-1, PARITY),
                [frozenset(x) for x in half.column("before").to_pylist()]))
        (node1, n1, label1, _, r1, p1, before1), (node2, n2, label2, main2, r2, p2, before2) = halves
        out: list[list[int]] = [[], []]
        for i in range(len(node1)):
            n = n1[i]
            at = np.flatnonzero(
                (label2 != label1[i]) & ((label2 == main2) | (node1[i] < node2))
                & (100 * np.minimum(n, n2) >= percent * np.maximum(n, n2)))
            apart = n + n2[at] - 2 * -(-percent * (n + n2[at]) // (100 + percent))
            at = at[np.bitwise_count(p2[at] ^ p1[i]).sum(axis=1, dtype=np.int64) <= apart]
            at = at[(r2[at] == r1[i]).sum(axis=1) >= near]
            if not len(at):
                continue
            fits = likely((r1[i] > r2[at]).sum(axis=1), (r1[i] < r2[at]).sum(axis=1), np.full(len(at), float(n)), n2[at].astype(float), percent)
            for j in at[fits].tolist():
                if not before1[i] & before2[j]:
                    out[0].append(min(int(node1[i]), int(node2[j])))
                    out[1].append(max(int(node1[i]), int(node2[j])))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            cell = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            edges = np.concatenate(([0], np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1, [len(cell)]))
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if low == high:
                    continue
                if held and tuple(cell[low]) != key:
                    yield pairs(pa.Table.from_batches(held))
                    held = []
                key = tuple(cell[low])
                held.append(batch.slice(low, high - low))
        if held:
            yield pairs(pa.Table.from_batches(held))

    return run


def _nodes(table: DataFrame) -> DataFrame:
    """A node for every set: the smallest id that has it, or a hash if that id has several sets."""
    by_set = written(table.filter("n > 0").groupBy("sid").agg(
        F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("registers").alias("registers"),
        F.first("parity").alias("parity")), "sets")
    several = by_set.groupBy("doc").agg(F.count("*").alias("c")).filter("c > 1").select("doc", F.lit(True).alias("odd"))
    named = by_set.join(several, "doc", "left")
    node = F.when(F.col("doc").isNull() | F.col("odd"), F.xxhash64("sid")).otherwise(F.col("doc"))
    return written(named.select(node.alias("node"), "doc", "sid", "n", "registers", "parity"), "nodes")


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members (``doc_id``, ``n_shingles``, ``node``), links (a, b) that tell the components, and labels."""
    table = written(sketches(docs, words, text, doc_id), "sketches")
    nodes = _nodes(table)
    members = table.select("doc_id", F.col("n").alias("n_shingles"), "sid").join(nodes.select("sid", "node"), "sid", "left").drop("sid")

    keyed = map_batches(nodes.select("node", "n", "registers"), _keys, "node long, n long, keys array<long>")
    postings = written(keyed.select("node", "n", F.explode("keys").alias("key")), "postings")
    met = written(postings.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key"), "met")
    postings = written(postings.join(met, "key"), "postings")
    registers = nodes.select("node", "registers", "parity")
    close, near = at_least(percent, 1), at_least(percent, 5)

    def promising(pairs: DataFrame) -> DataFrame:
        """For each node the two partners that agree best with it, as pairs (a, b)."""
        of = lambda end: nodes.select(*[F.col(c).alias(f"{c[0]}_{end}" if c != "node" else end) for c in ("node", "n", "registers", "parity")])
        met = pairs.distinct().join(of("node"), "node").join(of("hub"), "hub").withColumn("same", equal(F.col("r_node"), F.col("r_hub")))
        best = Window.partitionBy("node").orderBy(F.col("same").desc(), "hub")
        reach = within_reach(F.col("p_node"), F.col("p_hub"), F.col("n_node"), F.col("n_hub"), percent)
        best = met.filter((F.col("same") >= close) & reach).select("node", "hub", "same").withColumn("nth", F.row_number().over(best)).filter("nth <= 2")
        best = best.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        return _estimated(best, nodes, percent)

    # First one member of like size in each bucket, with those of the others that it may be linked with.
    step = F.floor(F.log("n") / F.lit(math.log(100 / min(percent, 99)))).cast("int")
    stepped = postings.withColumn("step", step)
    hub = F.min(F.struct(F.xxhash64("node", "key").alias("h"), "node", "n")).alias("hub")
    hubs = stepped.groupBy("key", "step").agg(hub, F.count("*").alias("c")).filter("c > 1").select(
        "key", "step", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"))
    star = stepped.join(hubs, ["key", "step"]).filter((F.col("node") != F.col("hub")) & _like("n", "hub_n", percent))
    tried = written(promising(star.select("node", "hub")), "tried")
    links = verified(tried, nodes, docs, words, percent, text, doc_id)
    labels = components(links)

    # Then, while that gains a link for every hundred members, another member of each bucket that is still in several ones.
    merged, turn = True, 0
    while True:
        placed = postings.join(labels, "node", "left").select("key", "node", "n", F.coalesce("label", "node").alias("label"))
        placed = written(placed, "placed")
        open_ = written(placed.groupBy("key", "label").agg(F.count("*").alias("c")).groupBy("key").agg(
            F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("squares"), F.max(F.struct("c", "label")).alias("main"),
            F.count("*").alias("k")).filter("k > 1").select(
            "key", "c", F.col("main.label").alias("main"), F.floor((F.col("c") * F.col("c") - F.col("squares")) / 2).alias("across")), "open")
        active = written(placed.join(open_.select("key", "main"), "key"), "active")
        members_of, across = open_.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("across"), F.lit(0))).first()
        if across <= SPARSE * members_of or not merged:
            break
        turn += 1
        hub = F.min(F.struct(F.xxhash64("node", "key", F.lit(turn)).alias("h"), "node", "n", "label")).alias("hub")
        hubs = active.groupBy("key").agg(hub).select("key", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.label").alias("of"))
        more = active.join(hubs, "key").filter((F.col("label") != F.col("of")) & _like("n", "hub_n", percent)).select("node", "hub")
        more = written(promising(more).join(tried, ["a", "b"], "left_anti"), "more")
        found = verified(more, nodes, docs, words, percent, text, doc_id)
        tried = written(tried.unionByName(more), "tried")
        gained = found.count()
        merged = 100 * gained >= members_of
        if gained:
            links = written(links.unionByName(found), "links")
            labels = components(links)

    # What is left: all pairs across components whose registers allow a link, under the first of their
    # common keys. Members of a bucket's largest component only meet the others.
    keys = active.groupBy("node").agg(F.collect_list("key").alias("keys"))
    full = active.join(keys, "node").join(registers, "node").withColumn("before", F.filter("keys", lambda k: k < F.col("key")))
    own = F.pmod(F.xxhash64("node"), F.col("parts"))
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    full = full.join(open_.select("key", F.ceil(F.col("c") / CELL).cast("long").alias("parts")), "key")
    columns = ["node", "n", "label", "main", "before", "registers", "parity"]
    one = full.filter("label <> main").select("key", own.alias("i"), F.explode(every).alias("j"), F.lit(0).alias("side"), *columns)
    two = full.select("key", F.explode(every).alias("i"), own.alias("j"), F.lit(1).alias("side"), *columns)
    cells = one.unionByName(two).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    rest = cells.mapInArrow(_across(percent, near), "a long, b long").distinct()
    rest = written(rest.join(tried, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        links = written(links.unionByName(verified(rest, nodes, docs, words, percent, text, doc_id)), "links")
        labels = components(links)
    return members, links, labels


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, the smallest id that links lead to, and ``kept``."""
    members, _, labels = join(docs, words, percent, text, doc_id)
    placed = written(members.join(labels, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("label", "node").alias("label")), "members")
    names = placed.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = placed.filter("label IS NOT NULL").join(names, "label")
    alone = placed.filter("label IS NULL").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")]
    return named.select(*columns).unionByName(alone.select(*columns))
