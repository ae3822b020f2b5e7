"""N-gram Jaccard join by partitions of the shingle universe.

A document's set holds its distinct five-word shingles (64-bit hashes). Equal
sets form a class; classes are joined, not documents.

In every size band the universe of shingles is hashed into a fixed number of
segments. An allocation says how a band's segments are indexed:

* whole: by the hash of the set's elements in the segment; two sets meet in a
  segment where they are equal;
* one-deletion: also by the hash with any one element left out; they meet in a
  segment where they differ by at most one element;
* subsets: by each one-element subset; they meet in a common element.

Two sets of sizes a and b with the wanted likeness t differ in at most ``H`` =
``floor((a + b) (1 - t) / (1 + t))`` elements, each of which spoils one segment
at most. With whole segments, part of which may have one-deletion
neighbourhoods, sets that do not meet in the latter spent at least 2 differences
(1 where a set has one element) on each; so of the others, in one global order,
the first ``H + 1`` less what was spent must have one in common. With subsets,
the set itself can lack at most its size less the common elements: the first
``n - ceil(2 t n / (1 + t)) + 1`` elements suffice towards larger partners
("leading" rows), ``n - ceil(t n) + 1`` towards smaller ones; a pair meets in a
leading row of the smaller set. What stands before the first element that two
sets have in common is lost to both, so where they meet at ranks i and j they
have at most ``min(a - i, b - j)`` in common; pairs for which that is too little
are passed over (their first common element shows them if they are alike).

The order is by the count of the rarest shingle in a table of fixed size
gathered from the whole corpus, then by hash. The allocation of a band is the
cheapest by rows and expected partners, summed over all sets. A set whose filled
segments do not reach ``H + 1`` is also indexed by its single cheapest shingles;
a pair is missed only if neither set is covered, and such sets meet there.

A set is indexed in its own band and in the next if a partner may lie there.

Sets that meet are candidates. In each meeting group one class, the hub, is
compared with all others; classes found alike are contracted; hubs are chosen
anew where a group still holds several components, and after some rounds the
rest of the pairs between components is compared. So no link between components
is lost, though pairs inside one are not all compared.

A pair is first judged by sizes and by counts of shingles in cells of the
universe (a byte for about two shingles): the sets differ by at least the
difference of the counts. Only for pairs that pass are the sets themselves
brought together, and the common shingles counted.

Defined cases: a null text, or one without words, has an empty set, no link and
its own id as component. Rows with one id are one node: what links to one of
its texts is linked to all of them. (``keep_one`` judges rows by their own
texts.) A null id is no node; it keeps a null component if nothing is linked to it. Hashes of 64 bits stand for shingles and
sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.llm.components import components
from sheafwork.llm.jobs import every, record, stage
from sheafwork.llm.textops import byte_hashes, lower_ascii, mix, sort_within, span_hashes, text_chunks, windows, word_spans

WORDS = 5
PERCENT = 80
BAND_RATIO = 4
#: Table of shingle counts behind the cost order.
COUNT_BUCKETS = 1 << 16
#: Allocations of a band: one-element subsets, or whole segments with the given
#: share of one-deletion neighbourhoods.
SUBSETS = -1.0
OPTIONS = (SUBSETS, 0.0, 1 / 8)
#: Bits of the filter for classes that need comparing.
FILTER_BITS = 1 << 23
HUB_ROUNDS = 2


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, and the first of each (n + 1)."""
    low = lower_ascii(data)
    starts, ends, first = word_spans(low, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    words = byte_hashes(low, starts, ends)
    at, h = windows(words, first, WORDS)
    begin = np.searchsorted(at, first)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):
        h = np.insert(h, begin[short], span_hashes(words, first[short], first[short + 1]))
        begin = begin + np.searchsorted(short, np.arange(len(begin)))
    sort_within(h, begin)
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    new[begin[:-1][begin[:-1] < len(h)]] = True
    return h[new], np.append(0, np.cumsum(new))[begin]


def _segment_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.append(np.uint64(0), np.cumsum(values, dtype=np.uint64))
    return total[first[1:]] - total[first[:-1]]


def class_ids(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit id of each set."""
    return mix(_segment_sum(mix(h + np.uint64(77)), first) + np.diff(first).astype(np.uint64)).view(np.int64)


def bounds(limit: int) -> np.ndarray:
    out = [1]
    while out[-1] <= limit:
        out.append(out[-1] * BAND_RATIO)
    return np.array(out, np.int64)


_BOUNDS = bounds(1 << 40)


@dataclass(frozen=True)
class Entries:
    """Sets as they stand in a band: one entry for each set and band."""

    doc: np.ndarray
    band: np.ndarray
    differ: np.ndarray  # H
    segments: np.ndarray
    leading: np.ndarray  # elements to index towards larger partners
    all: np.ndarray  # elements to index at all


def entries(sizes: np.ndarray, percent: int = PERCENT) -> Entries:
    filled = np.flatnonzero(sizes)
    n = sizes[filled]
    band = np.searchsorted(_BOUNDS, n, "right") - 1
    top = _BOUNDS[band + 1] - 1
    largest = n * 100 // percent
    over = np.flatnonzero(largest > top)
    doc = np.concatenate([filled, filled[over]])
    bands = np.concatenate([band, band[over] + 1])
    partner = np.concatenate([np.minimum(top, largest), largest[over]])
    differ = (np.concatenate([n, n[over]]) + partner) * (100 - percent) // (100 + percent)
    leading = n - -(-2 * percent * n // (100 + percent)) + 1
    every = n - -(-percent * n // 100) + 1
    # In the next band all partners are larger.
    return Entries(
        doc, bands, differ, np.clip(_BOUNDS[bands + 1] // 2, 1, 1 << 24),
        np.concatenate([leading, leading[over]]), np.concatenate([every, leading[over]]),
    )


def _take(e: Entries, which: np.ndarray) -> Entries:
    return Entries(*(getattr(e, f)[which] for f in ("doc", "band", "differ", "segments", "leading", "all")))


def _elements(h: np.ndarray, first: np.ndarray, e: Entries) -> tuple[np.ndarray, np.ndarray]:
    """Elements of all entries, and the entry of each."""
    sizes = (first[1:] - first[:-1])[e.doc]
    entry = np.repeat(np.arange(len(e.doc)), sizes)
    index = np.arange(len(entry)) + np.repeat(first[e.doc] - (np.cumsum(sizes) - sizes), sizes)
    return h[index], entry


def _bucket(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(24)) & np.uint64(COUNT_BUCKETS - 1)).astype(np.int64)


def cost_code(cost: np.ndarray) -> np.ndarray:
    """16 bits that keep the order of costs below 2^42: exact below 4096, then 12 leading bits."""
    cost = np.minimum(cost, (1 << 42) - 1)
    # The double of a number below 2^53 is exact, so its exponent is the number's length in bits.
    shift = np.maximum(np.frexp(cost.astype(np.float64))[1].astype(np.int64) - 12, 0)
    return (shift << 11) + (cost >> shift)


def code_cost(code: np.ndarray) -> np.ndarray:
    """The least cost with this code."""
    shift = np.maximum((code >> 11) - 1, 0)
    return (code - (shift << 11)) << shift


def _order_key(cost: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Place in the cost order: code of the cost (16 bits), then hash (48)."""
    return cost_code(cost).astype(np.uint64) << np.uint64(48) | h >> np.uint64(16)


def _first_elements(h: np.ndarray, first: np.ndarray, e: Entries, counts: np.ndarray):
    """The elements to index by one-element subsets: order key, entry, cost, rank in the order."""
    x, entry = _elements(h, first, e)
    key = _order_key(counts[_bucket(x)], x)
    begin = np.searchsorted(entry, np.arange(len(e.doc) + 1))
    sort_within(key, begin)
    rank = np.arange(len(key)) - begin[entry]
    kept = rank < e.all[entry]
    key = key[kept]
    return key, entry[kept], code_cost((key >> np.uint64(48)).astype(np.int64)), rank[kept]


@dataclass(frozen=True)
class Filled:
    """Filled segments of all entries, by entry."""

    entry: np.ndarray
    segment: np.ndarray
    size: np.ndarray
    total: np.ndarray  # commutative hash of the elements
    cost: np.ndarray
    element_slot: np.ndarray  # for each element its filled segment
    element_hash: np.ndarray


def fill(h: np.ndarray, first: np.ndarray, e: Entries, counts: np.ndarray) -> Filled:
    x, entry = _elements(h, first, e)
    place = mix(x ^ mix(e.band.astype(np.uint64) + np.uint64(1000))[entry])
    segment = ((place >> np.uint64(32)) % e.segments[entry].astype(np.uint64)).astype(np.int64)
    # Sorted by segment in each entry; 40 bits of the hash stand for the element.
    key = segment.astype(np.uint64) << np.uint64(40) | x >> np.uint64(24)
    sort_within(key, np.searchsorted(entry, np.arange(len(e.doc) + 1)))
    segment, x = (key >> np.uint64(40)).astype(np.int64), key & np.uint64((1 << 40) - 1)
    new = np.ones(len(key), dtype=bool)
    new[1:] = (segment[1:] != segment[:-1]) | (entry[1:] != entry[:-1])
    begin = np.flatnonzero(new)
    element = mix(x + np.uint64(12345))
    edges = np.append(begin, len(key))
    cost = counts[(x & np.uint64(COUNT_BUCKETS - 1)).astype(np.int64)]
    return Filled(
        entry[begin], segment[begin], np.diff(edges), _segment_sum(element, edges),
        np.minimum.reduceat(cost, begin) if len(begin) else cost[:0], np.cumsum(new) - 1, element,
    )


def _spent(f: Filled, second: np.ndarray, n_entries: int) -> np.ndarray:
    """Differences that an entry's segments of the second kind account for."""
    return np.bincount(f.entry[second], weights=np.minimum(f.size[second], 2), minlength=n_entries).astype(np.int64)


def _cheapest(f: Filled, sig: np.ndarray, use: np.ndarray, need: np.ndarray) -> np.ndarray:
    """The segments among ``use`` that are the first ``need`` of their entry in the cost order."""
    which = np.flatnonzero(use)
    entry = f.entry[which]
    key = _order_key(f.cost[which], sig[which])
    begin = np.searchsorted(entry, np.arange(len(need) + 1))
    ordered = key.copy()
    sort_within(ordered, begin)
    count = np.diff(begin)
    last = begin[:-1] + np.clip(need, 1, np.maximum(count, 1)) - 1
    limit = ordered[np.minimum(last, max(len(key) - 1, 0))] if len(key) else np.zeros(len(need), np.uint64)
    return which[(key <= limit[entry]) & (need[entry] > 0)]


def signatures(h: np.ndarray, first: np.ndarray, counts: np.ndarray, shares: np.ndarray, percent: int = PERCENT):
    """Index rows of all sets: signature, number of the set, rank, whether leading."""
    every = entries(np.diff(first), percent)
    by_subset = shares[every.band] == SUBSETS
    e = _take(every, by_subset)
    key, entry, _, rank = _first_elements(h, first, e, counts)
    out = [mix(key ^ mix(e.band.astype(np.uint64) + np.uint64(9000))[entry])]
    doc, ranks, lead = [e.doc[entry]], [rank], [rank < e.leading[entry]]
    e = _take(every, ~by_subset)
    if len(e.doc):
        f = fill(h, first, e, counts)
        second = f.segment < (shares[e.band] * e.segments).astype(np.int64)[f.entry]
        domain = mix(e.band[f.entry].astype(np.uint64) * np.uint64(1 << 40) + f.segment.astype(np.uint64))
        sig = mix(f.total ^ domain)
        need = np.maximum(e.differ - _spent(f, second, len(e.doc)) + 1, 0)
        kept = _cheapest(f, sig, ~second, need)
        out += [sig[kept], sig[second]]
        doc += [e.doc[f.entry[kept]], e.doc[f.entry[second]]]
        # One-deletion neighbourhoods; with one element nothing would be left.
        deleted = (second & (f.size > 1))[f.element_slot]
        slot = f.element_slot[deleted]
        out.append(mix((f.total[slot] - f.element_hash[deleted]) ^ domain[slot]))
        doc.append(e.doc[f.entry[slot]])
        got = np.bincount(f.entry[kept], minlength=len(e.doc))
        for i in np.flatnonzero(got < need):
            own = h[first[e.doc[i]] : first[e.doc[i] + 1]]
            cost = counts[_bucket(own)]
            single = own[np.lexsort((own, cost))[: e.differ[i] + 1]]
            out.append(mix(single ^ mix(np.uint64([e.band[i] + 5000]))))
            doc.append(np.full(len(single), e.doc[i]))
        more = sum(map(len, doc[1:]))
        ranks.append(np.zeros(more, np.int64))
        lead.append(np.ones(more, dtype=bool))
    return np.concatenate(out).view(np.int64), np.concatenate(doc), np.concatenate(ranks), np.concatenate(lead)


def _option_costs(h, first, counts, percent) -> dict[tuple[int, int], float]:
    """Rows and expected partners of each allocation, by band."""
    e = entries(np.diff(first), percent)
    costs: dict[tuple[int, int], float] = {}
    if not len(e.doc):
        return costs
    f = fill(h, first, e, counts)
    for o, share in enumerate(OPTIONS):
        if share == SUBSETS:
            _, entry, cost, _ = _first_elements(h, first, e, counts)
            total = np.bincount(entry, weights=1 + cost, minlength=len(e.doc))
        else:
            second = f.segment < (share * e.segments).astype(np.int64)[f.entry]
            need = np.maximum(e.differ - _spent(f, second, len(e.doc)) + 1, 0)
            kept = _cheapest(f, f.total, ~second, need)
            total = np.bincount(f.entry[kept], weights=1 + f.cost[kept], minlength=len(e.doc))
            rows = np.where(f.size[second] > 1, f.size[second] + 1, 1) * (1 + f.cost[second])
            total = total + np.bincount(f.entry[second], weights=rows, minlength=len(e.doc))
        for b, c in enumerate(np.bincount(e.band, weights=total)):
            if c:
                costs[b, o] = costs.get((b, o), 0.0) + c
    return costs


def _first_of_class(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Sets of each batch with class ids; ``new`` marks classes not yet met in the task."""
    seen: set[int] = set()
    for batch, data, offsets in text_chunks(batches, "_text"):
        h, first = shingle_sets(data, offsets)
        cls = class_ids(h, first)
        new = np.zeros(len(cls), dtype=bool)
        for i, (c, n) in enumerate(zip(cls.tolist(), np.diff(first).tolist())):
            if n and c not in seen:
                seen.add(c)
                new[i] = True
        yield batch, h, first, cls, new


def _only(h: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(first)[which]
    at = np.cumsum(sizes) - sizes
    index = np.arange(sizes.sum()) + np.repeat(first[:-1][which] - at, sizes)
    return h[index], np.append(at, sizes.sum())


def _survey(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, costs = np.zeros(COUNT_BUCKETS, np.int64), {}
        for batch, h, first, cls, new in _first_of_class(batches):
            n = len(cls)
            sizes = np.diff(first)
            yield record(
                kind=pa.array([0] * n, pa.int32()), doc_id=batch.column("_id"), hash=batch.column("_hash"), n=pa.array(sizes, pa.int64()),
                cls=pa.array(cls, pa.int64(), mask=sizes == 0), value=pa.nulls(n, pa.float64()),
            )
            x, f = _only(h, first, np.flatnonzero(new))
            counts += np.bincount(_bucket(x), minlength=COUNT_BUCKETS)
            # Costs by the counts of this task so far: an estimate that only steers the choice.
            for k, c in _option_costs(x, f, counts, percent).items():
                costs[k] = costs.get(k, 0.0) + c
        used = np.flatnonzero(counts)
        keys = [b * len(OPTIONS) + o for b, o in costs]
        yield record(
            kind=pa.array([1] * len(used) + [2] * len(keys), pa.int32()), doc_id=pa.nulls(len(used) + len(keys), pa.int64()),
            hash=pa.nulls(len(used) + len(keys), pa.int64()), n=pa.array([*used.tolist(), *keys], pa.int64()), cls=pa.nulls(len(used) + len(keys), pa.int64()),
            value=pa.array([*counts[used].astype(float).tolist(), *costs.values()], pa.float64()),
        )

    return run


#: Factor of the size in ``info``; the rank is counted in twos.
_SIZE = 1 << 32


def _info(size: np.ndarray, rank: np.ndarray, leading: np.ndarray) -> np.ndarray:
    return size * _SIZE + 2 * rank + ~leading


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    """Whether two rows' sizes leave room for the wanted likeness."""
    n, m = F.shiftright(a, 32), F.shiftright(b, 32)
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _ranks_fit(a: str, b: str, percent: int) -> Column:
    """Whether two rows' ranks leave room for it, if they are the first that the sets share."""
    (n, i), (m, j) = (
        (F.shiftright(x, 32), F.shiftright(F.col(x).bitwiseAND(F.lit(_SIZE - 1)), 1)) for x in (a, b)
    )
    return (100 + percent) * F.least(n - i, m - j) >= percent * (n + m)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From index rows sorted by signature, leading rows first: classes that meet, with the first one as hub.

    ``info`` holds the size of the set, the rank, and whether the row does not
    lead (``_info``). A hub leads; where no row does, nothing meets.
    """
    last_sig = last_cls = hub = None
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, cls, info = (batch.column(c).to_numpy() for c in ("sig", "cls", "info"))
        new_sig, new_cls = np.ones(len(sig), dtype=bool), np.ones(len(sig), dtype=bool)
        new_sig[1:], new_cls[1:] = sig[1:] != sig[:-1], cls[1:] != cls[:-1]
        new_sig[0], new_cls[0] = sig[0] != last_sig, cls[0] != last_cls
        begin = np.where(new_sig, np.arange(len(sig)), -1)
        np.maximum.accumulate(begin, out=begin)
        carried = hub if hub is not None else (0, 1)
        hubs = np.where(begin < 0, carried[0], cls[np.maximum(begin, 0)])
        infos = np.where(begin < 0, carried[1], info[np.maximum(begin, 0)])
        member = ~new_sig & new_cls & (cls != hubs) & (infos & 1 == 0)
        yield record(
            sig=pa.array(sig[member]), hub=pa.array(hubs[member]), hub_info=pa.array(infos[member]),
            cls=pa.array(cls[member]), info=pa.array(info[member]),
        )
        last_sig, last_cls, hub = int(sig[-1]), int(cls[-1]), (int(hubs[-1]), int(infos[-1]))


def _compare(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for x, y in zip(batch.column("value_a"), batch.column("value_b")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                alike.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    return run


def _class_filter(classes: DataFrame) -> np.ndarray:
    """Bitmap of fixed size over class ids; false hits only mean some rows more."""
    bit = F.col("cls").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = classes.select(
        F.shiftright(bit, 6).alias("w"), F.expr("shiftleft(1L, cast(cls & 63 as int))").alias("v")
    )
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for w, v in words.groupBy("w").agg(F.bit_or("v")).collect():
        out[w] = v
    return out


def class_links(docs: DataFrame, percent: int = PERCENT, options: tuple[float, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents with set size and class, and links that connect all classes that are alike.

    ``docs`` has ``_id``, ``_text`` and ``_hash`` (of the text). To the driver come the table of shingle
    counts (``COUNT_BUCKETS`` numbers), the costs by band and the class filter
    (``FILTER_BITS``), all of fixed size.
    """
    spark = docs.sparkSession
    survey = stage(docs.mapInArrow(_survey(percent), "kind int, doc_id long, hash long, n long, cls long, value double"), "shingle_survey")
    members = survey.where("kind = 0").select("doc_id", "hash", F.col("n").alias("n_shingles"), "cls")
    counts = np.zeros(COUNT_BUCKETS, np.int64)
    costs: dict[int, float] = {}
    for kind, n, value in survey.where("kind > 0").groupBy("kind", "n").agg(F.sum("value")).collect():
        if kind == 1:
            counts[n] = int(value)
        else:
            costs[n] = value
    shares = np.zeros(len(_BOUNDS) + 1)
    for b in range(len(shares)):
        if options is not None:
            shares[b] = options[b % len(options)]
        else:
            shares[b] = OPTIONS[min(range(len(OPTIONS)), key=lambda o: (costs.get(b * len(OPTIONS) + o, 0.0), o))]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, first, cls, new in _first_of_class(batches):
            which = np.flatnonzero(new)
            sig, doc, rank, leading = signatures(*_only(h, first, which), counts, shares, percent)
            info = _info(np.diff(first)[which][doc], rank, leading)
            yield record(sig=pa.array(sig, pa.int64()), cls=pa.array(cls[which][doc], pa.int64()), info=pa.array(info, pa.int64()))

    rows = docs.mapInArrow(index, "sig long, cls long, info long").repartition("sig")
    rows = rows.sortWithinPartitions("sig", F.col("info").bitwiseAND(F.lit(1)), "cls")
    met = stage(rows.mapInArrow(_groups, "sig long, hub long, hub_info long, cls long, info long"), "shingle_groups")

    return members, _links(docs, met, percent)


def _class_rows(docs: DataFrame, classes: DataFrame, value: Callable[[np.ndarray], bytes | None]) -> DataFrame:
    """For the given classes (``cls``): ``n`` and a value made of the set; one row each."""
    bits = _class_filter(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, first, cls, new in _first_of_class(batches):
            bit = cls & (FILTER_BITS - 1)
            which = np.flatnonzero(new & ((bits[bit >> 6] >> (bit & 63)) & 1 == 1))
            raw = [value(h[first[i] : first[i + 1]]) for i in which]
            yield record(cls=pa.array(cls[which]), n=pa.array(np.diff(first)[which]), value=pa.array(raw, pa.binary()))

    return docs.mapInArrow(run, "cls long, n long, value binary").dropDuplicates(["cls"])


def cell_counts(h: np.ndarray) -> bytes | None:
    """Shingles in each cell; a power of two of cells. Null if a count needs more than a byte."""
    cells = 1 << max(6, int(len(h) // 2).bit_length())
    counts = np.bincount(((h >> np.uint64(8)) & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else None


def may_be_alike(n_a: int, n_b: int, a: bytes | None, b: bytes | None, percent: int) -> bool:
    """False if sizes or cell counts show that two sets are not alike."""
    if 100 * min(n_a, n_b) < percent * max(n_a, n_b):
        return False
    if a is None or b is None:
        return True
    x, y = (np.frombuffer(c, np.uint8).astype(np.int32) for c in (a, b))
    cells = min(len(x), len(y))
    # The cell is the low bits of the hash, so larger tables fold onto smaller ones.
    x, y = x.reshape(-1, cells).sum(axis=0), y.reshape(-1, cells).sum(axis=0)
    return int(np.abs(x - y).sum()) <= (n_a + n_b) * (100 - percent) // (100 + percent)


def _screen(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = [batch.column(x) for x in ("n_a", "n_b", "value_a", "value_b")]
            keep = [may_be_alike(na.as_py(), nb.as_py(), x.as_py(), y.as_py(), percent) for na, nb, x, y in zip(*c)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _both(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs with ``n`` and ``value`` of both classes."""
    for side in ("a", "b"):
        pairs = pairs.join(rows.select(*(F.col(c).alias(d) for c, d in (("cls", side), ("n", f"n_{side}"), ("value", f"value_{side}")))), side)
    return pairs


def _links(docs: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """Links (``a``, ``b``) that connect every component of alike classes."""
    rows = stage(
        met.select("sig", "cls", "info").union(met.select("sig", F.col("hub").alias("cls"), F.col("hub_info").alias("info"))).distinct(),
        "index_rows",
    )
    cells = stage(_class_rows(docs, rows.select("cls"), cell_counts), "shingle_cells")

    def compare(pairs: DataFrame, k: int) -> DataFrame:
        passed = stage(_both(pairs, cells).mapInArrow(_screen(percent), "a long, b long"), f"screened_{k}")
        classes = passed.select(F.explode(F.array("a", "b")).alias("cls"))
        sets = stage(_class_rows(docs, classes, lambda h: h.tobytes()), "shingle_sets")
        return stage(_both(passed, sets).mapInArrow(_compare(percent), "a long, b long"), f"links_{k}")

    def ordered(a: str, b: str) -> list:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    tested = stage(met.where(_sizes_fit("hub_info", "info", percent)).select(*ordered("hub", "cls")).distinct(), "pairs")
    links = compare(tested, 0)
    for k in range(1, HUB_ROUNDS + 1):
        roots = components(links, "a", "b").select(F.col("node").alias("cls"), "root")
        rooted = rows.join(roots, "cls", "left").select("sig", "cls", "info", F.coalesce("root", "cls").alias("root"))
        spread = rooted.groupBy("sig").agg(
            F.min("root").alias("low"), F.max("root").alias("high"),
            F.min_by(F.struct("cls", "info", "root"), F.struct(F.col("info").bitwiseAND(F.lit(1)), F.xxhash64("cls", F.lit(k)))).alias("hub"),
        ).where("low <> high").select("sig", "hub")
        rooted = stage(rooted.join(spread, "sig"), "open_groups")
        if not rooted.limit(1).count():
            break
        rows = rooted.select("sig", "cls", "info")
        if k < HUB_ROUNDS:
            pairs = rooted.where((F.col("root") != F.col("hub.root")) & _sizes_fit("hub.info", "info", percent)).select(*ordered("hub.cls", "cls"))
        else:
            # Leading rows with the rows of sets that are not smaller.
            small = rooted.where("info & 1 = 0").select("sig", F.col("cls").alias("c"), F.col("info").alias("i"), F.col("root").alias("r"))
            larger = (F.shiftright("i", 32) <= F.shiftright("info", 32)) & _sizes_fit("i", "info", percent) & _ranks_fit("i", "info", percent)
            pairs = small.join(rooted, "sig").where((F.col("root") != F.col("r")) & larger).select(*ordered("c", "cls"))
        pairs = stage(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        if not pairs.limit(1).count():
            continue  # the hub may be an old one, or fit nobody: a later round still has pairs
        links = links.unionByName(compare(pairs, k))
        tested = tested.unionByName(pairs)
    return links


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_hash")
    )


def _joined_ids(members: DataFrame) -> DataFrame:
    """Ids with several classes, or with a class and an empty set: ``_i``, their smallest class ``_low``."""
    classes = members.where("doc_id is not null").groupBy(F.col("doc_id").alias("_i")).agg(
        F.min("cls").alias("_low"), F.max("cls").alias("_high"), F.count("cls").alias("_sets"), F.count("*").alias("_rows")
    )
    return stage(classes.where("_low <> _high or (_sets > 0 and _sets < _rows)").select("_i", "_low"), "joined_ids")


def components_table(
    docs: DataFrame, percent: int = PERCENT, options=None, id_col="doc_id", text_col="text", by_text: bool = False
) -> DataFrame:
    """Every document with ``n_shingles`` and ``component_id``.

    With ``by_text`` rows are nodes by their texts alone, whatever their ids, and
    the text's hash comes with them.
    """
    members, links = class_links(_named(docs, id_col, text_col), percent, options)
    if not by_text:
        joined = _joined_ids(members)
        members = members.join(joined, F.col("doc_id") == F.col("_i"), "left")
        same = members.where("cls <> _low").select(F.col("_low").alias("a"), F.col("cls").alias("b"))
        links = links.select("a", "b").union(same.distinct())
        members = members.withColumn("cls", F.coalesce("cls", "_low"))
    roots = components(links, "a", "b")
    rooted = members.join(roots, F.col("cls") == F.col("node"), "left").select(
        "doc_id", "hash", "n_shingles", F.coalesce("root", "cls").alias("root")
    )
    lowest = rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("low")).select(F.col("root").alias("_r"), "low")
    return rooted.join(lowest, F.col("root") == F.col("_r"), "left").select(
        "doc_id", *["hash"] * by_text, "n_shingles", F.coalesce("low", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, percent: int = PERCENT, id_col="doc_id", text_col="text") -> DataFrame:
    """One document of each component: the smallest id, then the smallest text hash.

    Documents with an empty set all stay. All columns are kept. Only documents
    that may go, by a bitmap of fixed size, are shuffled.
    """
    members = stage(components_table(docs, percent, None, id_col, text_col, True), "members")
    linked = members.where("n_shingles > 0")
    first = linked.groupBy("component_id").agg(F.min(F.struct("doc_id", "hash")).alias("first")).select(
        F.col("component_id").alias("_c"), "first"
    )
    # A text's rows: whether it is its component's first, and how many rows it has.
    texts = linked.groupBy("component_id", "doc_id", "hash").agg(F.count("*").alias("rows")).join(
        first, F.col("component_id").eqNullSafe(F.col("_c"))
    )
    going = stage(
        texts.select(
            F.col("doc_id").alias("_i"), F.col("hash").alias("_h"), "rows",
            F.struct("doc_id", "hash").eqNullSafe(F.col("first")).alias("_stays"),
        ).where("not _stays or rows > 1"),
        "going",
    )
    bits = _class_filter(going.select(F.col("_h").alias("cls")))
    packed = docs.select(F.struct(*every(docs)).alias("row"), F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_hash"))

    def part(inside: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bit = batch.column("_hash").to_numpy() & (FILTER_BITS - 1)
                yield batch.filter(pa.array(((bits[bit >> 6] >> (bit & 63)) & 1 == 1) == inside))

        return packed.mapInArrow(run, packed.schema)

    checked = part(True).join(going, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h")), "left")
    number = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("_stays"))
    stays = F.col("_stays").isNull() | (F.col("_stays") & (F.col("_n") == 1))
    checked = checked.withColumn("_n", number).where(stays)
    return part(False).select("row.*").unionByName(checked.select("row.*"))
