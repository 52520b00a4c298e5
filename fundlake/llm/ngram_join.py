"""Exact Jaccard join of word shingle sets: universe-partition pigeonhole.

Sets go into channels by size. A channel hashes the universe of shingles into segments and gives each set a signature per
segment it has shingles in. Two sets with a Jaccard similarity of at least 3/4 differ in at most a seventh of their
summed sizes, so they can differ in so many segments at most and must agree on the others. In small channels segments
are few and long and also take the signatures of all their one-deletion subsets, so that it takes two differences to
break one; ``plan`` chooses by cost. A set whose segments agree with those of any others in too few cases has no partner
and is gone after one meeting of signatures; of the rest, the rarest signatures that still suffice bring blocks of sets
together. Pairs of blocks that meet by accident grow faster than the input, so it is sketches of their sets that meet
first: bitmaps of parities, which differ in no more bits than the sets differ in shingles. Only sets with a partner that
their sketches allow are brought together, and these are compared exactly. Either meeting is held in as many rounds as
keep its files below the size of the texts.

Equal sets are one node, known by 64 bits of a hash while signatures meet and by 128 after that. Signatures travel as
packed arrays, some thousand to a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import buckets_for, read, rows_of, stage
from fundlake.llm.components import components
from fundlake.llm.hashing import PLACES, U64, mix, word_hashes

WORDS = 5
#: Signatures that meet in one bucket on average, and bytes of text that give one signature.
TOGETHER, BYTES_PER_SIGNATURE = 1_200_000, 13
#: Nodes in a block on average, at most.
BLOCK = 512
#: Shingles that are compared at once; larger blocks are compared piece by piece.
SHINGLES_TOGETHER = 1_000_000
#: Words of sketches that are compared at once, and bytes up to which there is one round.
WORDS_TOGETHER, LEAST_ROUND = 1_000_000, 1 << 26
#: Cost of an accidental agreement in signatures, and the chance that a shingle is one that many texts have.
ACCIDENT, COMMON = 1000.0, 0.02
#: Channel of single shingles for sets with too few segments.
SINGLES = 63

#: A signature on its way: 48 bits of it (the bucket has the rest), the node, and what the node needs in its channel.
ITEM = np.dtype([("low", "<u4"), ("high", "<u2"), ("node", "<i8"), ("need", "<u2"), ("tag", "<u2")])
#: A signature that nodes share, with the number of rows that have it.
MET = np.dtype([("sig", "<u8"), ("node", "<i8"), ("n", "<i4"), ("need", "<u2"), ("tag", "<u2")])
OWN = np.dtype([("doc_id", "<i8"), ("key", "<i8"), ("n", "<i8"), ("h1", "<i8"), ("h2", "<i8"), ("known", "?")])


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; of the whole sequence if it is shorter. A-Z is lowered,
    words are what stands between spaces and the control characters 9 to 13. Shingles are 64-bit hashes from here on."""
    joined = b" ".join(text.encode().lower().split())
    if not joined:
        return np.empty(0, U64)
    hashes = word_hashes(joined)[2]
    length = min(words, len(hashes))
    count = len(hashes) - length + 1
    runs = np.full(count, length, U64)
    for k in range(length):
        runs += hashes[k : k + count] * PLACES[k]
    return np.unique(mix(runs))


def channels(size: int) -> list[int]:
    """Channels of a set: its own power of two, and the next if a set that large may be similar."""
    own = size.bit_length() - 1
    return [own, own + 1] if 4 * size >= 3 << (own + 1) else [own]


def budget(size: int, channel: int) -> int:
    """Most differences to a similar set in ``channel``."""
    return (size + min((2 << channel) - 1, 4 * size // 3)) // 7


def _weight(size: float, exact: int, deleted: int) -> tuple[float, float]:
    """Mean and deviation of the summed weight of a set's segments: 1 for an exact one with shingles, 2 for one with
    deletions, 1 if it has a single shingle. Loads are taken as Poisson, given their sum."""
    load = size / (exact + deleted)
    none, one = math.exp(-load), load * math.exp(-load)
    twice = 2 - 2 * none - one
    mean = exact * (1 - none) + deleted * twice
    spread = exact * none * (1 - none) + deleted * (4 * (1 - none) - 3 * one - twice**2)
    bound = (exact * one + deleted * one * (1 + load)) ** 2 / size
    return mean, math.sqrt(max(0.0, spread - bound))


@lru_cache(maxsize=64)
def plan(channel: int) -> tuple[int, int]:
    """Exact segments and segments with deletions: the cheapest mix whose weight exceeds the budget for nearly all sets.

    The cost is that of the signatures of a middling set plus that of accidental agreements, which are rarer the more
    shingles must agree. Sets that the mix leaves without enough weight send their single shingles (``SINGLES``).
    """
    low, top = 3 << max(channel - 2, 0), (2 << channel) - 1
    best = None
    for share in (0.0, 0.5, 1.0):
        for segments in range(1, 4 * top):
            deleted = round(share * segments)
            exact = segments - deleted
            if deleted <= 100 and all(
                (w := _weight(size, exact, deleted))[0] - 2 * w[1] >= budget(size, channel) + 1
                for size in (max(3, low), top)
            ):
                break
        else:
            continue
        load = 1.5 * (1 << channel) / segments
        signatures = segments * (1 - math.exp(-load)) + deleted * load
        cost = signatures + ACCIDENT * (exact * COMMON**load + deleted * COMMON ** max(load - 1, 0))
        if best is None or cost < best[0]:
            best = cost, exact, deleted
    return best[1:] if best else (0, 0)


def signatures(own: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Channel, needed weight of agreeing segments, signatures and tags of a set.

    A tag has the channel in its upper byte. The lower one is 0 for an exact segment (weight 1); a segment with deletions
    has its number there, from 1, and its weight less one in the lowest bit.
    """
    size, weak = len(own), False
    for channel in channels(size):
        if (most := budget(size, channel)) == 0:
            continue  # only equal sets, which are one node
        exact, deleted = plan(channel)
        segments = exact + deleted
        if not segments:
            weak = True
            continue
        mixed = mix(own + U64(channel * 2 + 1))
        segment = (mixed >> U64(20)) % U64(segments)
        order = np.argsort(segment, kind="stable")
        segment, mixed = segment[order], mixed[order]
        first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        count = np.diff(np.append(first, size))
        total, number = np.add.reduceat(mixed, first), segment[first]
        salt = mix(number + U64((channel + 1) << 40))
        sigs, tags = [mix(total ^ salt)], [np.where(number < deleted, number * U64(2) + U64(2) + (count > 1).astype(U64), U64(0))]
        base = np.uint16(channel << 8)
        if deleted:
            inside = np.repeat((number < deleted) & (count > 1), count)
            sigs.append(mix((np.repeat(total, count) - mixed)[inside] ^ np.repeat(salt, count)[inside]))
            tags.append((segment * U64(2) + U64(3))[inside])
        need = int(np.where((number < deleted) & (count > 1), 2, 1).sum()) - most
        weak |= need <= 0
        yield channel, need, np.concatenate(sigs), np.concatenate(tags).astype(np.uint16) + base
    if weak:
        most = max(budget(size, channel) for channel in channels(size))
        yield SINGLES, size - most, mix(own + U64(0x5851F42D4C957F2D)), np.full(size, SINGLES << 8, np.uint16)


PACKED = "bucket long, kind int, head binary, body binary"
_PACKED_NAMES = ["bucket", "kind", "head", "body"]


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
    columns = zip(*rows, strict=True) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _PACKED_NAMES)


def _send(buckets: int):
    """Rows of (doc_id, key, text) to one packed row of set sizes and nodes, and one of signatures per bucket."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, sent, parts = [], set(), []
            for doc_id, key, text in rows_of(batch, "doc_id", "key", "text"):
                values = shingles(text or "")
                digest = xxhash.xxh3_128_intdigest(values.tobytes())
                h1, h2 = (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)
                own.append((doc_id or 0, key or 0, len(values), h1, h2, doc_id is not None))
                if doc_id is None or len(values) < 3 or h1 in sent:
                    continue
                sent.add(h1)
                for _, need, sigs, tags in signatures(values):
                    part = np.empty(len(sigs), ITEM)
                    # A need beyond 16 bits is lowered to what fits, which lets more through and loses nothing.
                    part["node"], part["need"], part["tag"] = h1, min(max(need, 1), 65_535), tags
                    parts.append((sigs, part))
            if own:
                yield _packed([(-1 - abs(own[0][3]) % (1 << 40), 0, np.array(own, OWN).tobytes(), None)])
            if not parts:
                continue
            sigs, items = (np.concatenate(x) for x in zip(*parts, strict=True))
            items["low"], items["high"] = sigs & U64(0xFFFFFFFF), (sigs >> U64(32)) & U64(0xFFFF)
            bucket = (sigs >> U64(16)) % U64(buckets)
            order = np.argsort(bucket, kind="stable")
            items, bucket = items[order], bucket[order]
            rows = [
                (int(bucket[first]), 1, None, items[first : first + count].tobytes())
                for first, count in zip(*(x.tolist() for x in _runs(bucket)), strict=True)
            ]
            yield _packed(rows)

    return send


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Consecutive rows of one bucket; rows come sorted by bucket."""
    rows = (row for batch in batches for row in zip(*(batch.column(name) for name in _PACKED_NAMES), strict=True))
    return groupby(rows, key=lambda row: row[0].as_py())


def _arrive(bucket: int, body: bytes) -> np.ndarray:
    items = np.frombuffer(body, ITEM)
    met = np.zeros(len(items), MET)
    for name in ("node", "need", "tag"):
        met[name] = items[name]
    met["sig"] = mix((items["low"] | items["high"].astype(U64) << U64(32)) ^ U64(bucket * 0x9E3779B97F4A7C15 % (1 << 64)))
    return met


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each run of equal sorted keys."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return first, np.diff(np.append(first, len(keys)))


def _shared(held: np.ndarray, told: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows whose signature two nodes have and that were not told yet, with the number of rows that have it; and what to
    hold of the bucket so far: of each signature one row, and a second of another node once it is shared."""
    order = np.argsort(held["sig"], kind="stable")
    held, told = held[order], told[order]
    first, count = _runs(held["sig"])
    other = held["node"] != np.repeat(held["node"][first], count)
    shared = np.add.reduceat(other, first) > 0 if len(first) else np.empty(0, bool)
    each = np.repeat(shared, count)
    new = held[each & ~told]
    new["n"] = np.repeat(count, count)[each & ~told]
    second = other & (np.cumsum(other) - np.repeat((np.cumsum(other) - other)[first], count) == 1)
    keep = second.copy()
    keep[first] = True
    return new, held[keep], each[keep]


def _meet(parts: int):
    """Signatures of a bucket to those that different nodes share, packed by node. Rows that go on are dealt out by node;
    a bucket holds two rows per signature at most, however many nodes have it."""

    def deal(new: np.ndarray) -> Iterator[pa.RecordBatch]:
        to = (new["node"].astype(U64) >> U64(9)) % U64(parts)
        order = np.argsort(to, kind="stable")
        new, to = new[order], to[order]
        for first, count in zip(*(x.tolist() for x in _runs(to)), strict=True):
            yield _packed([(int(to[first]), 1, None, new[first : first + count].tobytes())])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _buckets(batches):
            if bucket < 0:
                for _, kind, head, _ in rows:
                    yield _packed([(bucket, kind.as_py(), head.as_py(), None)])
                continue
            held, told, waiting, size = np.empty(0, MET), np.empty(0, bool), [], 0
            for _, _, _, body in rows:
                waiting.append(_arrive(bucket, body.as_py()))
                size += len(waiting[-1])
                if size > 2 * TOGETHER:
                    new, held, told = _shared(np.concatenate([held, *waiting]), np.concatenate([told, np.zeros(size, bool)]))
                    waiting, size = [], 0
                    yield from deal(new)
            if size:
                yield from deal(_shared(np.concatenate([held, *waiting]), np.concatenate([told, np.zeros(size, bool)]))[0])

    return meet


SURVEYED = "kind int, doc_id long, key long, n long, h1 long, h2 long, home long, probes array<long>, others array<long>"
_KINDS = [pa.int32(), *[pa.int64()] * 6, pa.list_(pa.int64()), pa.list_(pa.int64())]
_NAMES = [part.split()[0] for part in SURVEYED.split(", ")]


def _surveyed(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ((),) * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)


def _judge_node(rows: np.ndarray) -> tuple | None:
    """Home, probing and other shared signatures of a node in a channel, or None if it cannot have a partner. The home is
    the signature that most others share, so similar sets mostly have one home.

    ``need`` of the weight of its segments must agree with a partner, so of the shared ones all but ``need`` - 1 have to
    be asked for: the rarest.
    """
    need = int(rows["need"][0])
    single = rows["tag"] & 255 == 0
    deleted = np.unique(rows["tag"][~single])
    weight = int(single.sum()) + int((1 + (deleted & 1)).sum())
    if weight < need:
        return None
    order = np.lexsort((rows["sig"], rows["n"]))
    rows, single = rows[order], single[order]
    ask = weight - need + 1 - int((1 + (deleted & 1)).sum())
    probing = ~single | (np.cumsum(single) <= ask)
    sigs = rows["sig"].view(np.int64)
    return int(sigs[-1]), sigs[probing].tolist(), sigs[~probing].tolist()


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for bucket, rows in _buckets(batches):
        if bucket < 0:
            for _, _, head, _ in rows:
                for own in np.array_split(np.frombuffer(head.as_py(), OWN), 4):
                    yield _surveyed([(0, d if known else None, k, n, a, b, None, None, None) for d, k, n, a, b, known in own.tolist()])
            continue
        met = np.concatenate([np.frombuffer(body.as_py(), MET) for _, _, _, body in rows])
        met = met[np.lexsort((-met["n"], met["sig"], met["tag"] >> 8, met["node"]))]
        same = (met["node"][1:] == met["node"][:-1]) & (met["tag"][1:] >> 8 == met["tag"][:-1] >> 8)
        met = met[np.concatenate([[True], ~(same & (met["sig"][1:] == met["sig"][:-1]))])]
        same = (met["node"][1:] == met["node"][:-1]) & (met["tag"][1:] >> 8 == met["tag"][:-1] >> 8)
        cuts = np.flatnonzero(np.concatenate([[True], ~same, [True]]))
        out: list[list] = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b - a < met["need"][a] // 2 or not (found := _judge_node(met[a:b])):
                continue
            if out and out[-1][4] == int(met["node"][a]):
                # The next channel of a node: it keeps the home of the lower one, which smaller partners share.
                out[-1][7] += found[1]
                out[-1][8] += found[2]
                continue
            if len(out) >= 2000:
                yield _surveyed(out)
                out = []
            out.append([1, None, None, None, int(met["node"][a]), None, *found])
        yield _surveyed(out)


def similar(ids: list, sets: list[np.ndarray], split: int, percent: int = 75) -> list[tuple]:
    """Links that span the groups of similar sets among ``sets``: pairs of one before and one from ``split`` on, or any
    pair if ``split`` is 0."""
    leader = list(range(len(sets)))

    def top(k: int) -> int:
        while leader[k] != k:
            leader[k] = k = leader[leader[k]]
        return k

    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    owner, ends = np.repeat(np.arange(len(sets)), sizes), np.cumsum(sizes)
    by_value = np.argsort(place, kind="stable")
    starts = np.searchsorted(place[by_value], np.arange(len(values) + 1))
    owners, links = owner[by_value], []
    for k in range(split or len(sets)):
        own = place[ends[k] - sizes[k] : ends[k]]
        lengths = starts[own + 1] - starts[own]
        at = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        common = np.bincount(owners[at], minlength=len(sets))
        partners = np.flatnonzero(100 * common >= percent * (sizes[k] + sizes - common))
        for partner in partners[partners >= max(split, k + 1)].tolist():
            if ids[k] != ids[partner] and (a := top(k)) != (b := top(partner)):
                leader[a] = b
                links.append((ids[k], ids[partner]))
    return links


def _pieces(sets: list[np.ndarray], begin: int, end: int) -> list[tuple[int, int]]:
    """Ranges of ``sets`` from ``begin`` to ``end`` of at most ``SHINGLES_TOGETHER`` shingles, or of one set."""
    cuts, size = [begin], 0
    for k in range(begin, end):
        if size and size + len(sets[k]) > SHINGLES_TOGETHER:
            cuts.append(k)
            size = 0
        size += len(sets[k])
    return [(a, b) for a, b in zip(cuts, [*cuts[1:], end], strict=True) if a < b]


def similar_pieces(ids: list, sets: list[np.ndarray], split: int) -> list[tuple]:
    """As ``similar``, with a bounded number of shingles in hand; the links may be more than span the groups."""
    whole = not split
    left, right = _pieces(sets, 0, split or len(sets)), _pieces(sets, split, len(sets))
    links = []
    for k, (a, b) in enumerate(left):
        if whole:
            links += similar(ids[a:b], sets[a:b], 0)
        for c, d in right[k + 1 :] if whole else right:
            links += similar(ids[a:b] + ids[c:d], sets[a:b] + sets[c:d], b - a)
    return links


def sketch(own: np.ndarray) -> bytes:
    """Parities of the shingles by their last bits, in as many bits as the power of two from ``len(own)`` on, at least 64.
    Halves laid on each other (exclusive or) are the sketch of half as many bits."""
    bits = max(64, 1 << (len(own) - 1).bit_length())
    return np.packbits(np.bincount((own & U64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def _folded(sketches: list[bytes], words: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(sketches), U64).reshape(len(sketches), -1)
    while rows.shape[1] > words:
        rows = rows[:, : rows.shape[1] // 2] ^ rows[:, rows.shape[1] // 2 :]
    return rows


def possible(sizes: np.ndarray, sketches: list[bytes], split: int) -> np.ndarray:
    """Which sets may have a similar one on the other side of ``split``, or anywhere if ``split`` is 0. Similar sets differ
    in a seventh of their summed sizes at most, so their sketches do, and their sketches' sizes are the same or neighbours."""
    found = np.zeros(len(sizes), bool)
    words = np.array([len(x) // 8 for x in sketches])
    place = np.arange(len(sizes))
    for own in np.unique(words[: split or len(words)]).tolist():
        left = np.flatnonzero((words == own) & (place < (split or len(words))))
        for other in (own // 2, own, own * 2) if split else (own // 2, own):
            right = np.flatnonzero((words == other) & (place >= split))
            if not len(right):
                continue
            a, b = (_folded([sketches[k] for k in side.tolist()], min(own, other)) for side in (left, right))
            step = max(1, WORDS_TOGETHER // b.size)
            for at in range(0, len(left), step):
                some = left[at : at + step]
                far = np.bitwise_count(a[at : at + step, None] ^ b[None]).sum(2, dtype=np.int64)
                near = (7 * far <= sizes[some, None] + sizes[None, right]) & (some[:, None] != right[None])
                found[some[near.any(1)]] = True
                found[right[near.any(0)]] = True
    return found


SIFTED = "a long, b long, side int, doc_id long, key long"


def _sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each pair of blocks the sets that may have a partner, each once; rows come sorted by pair and side."""
    names = [part.split()[0] for part in SIFTED.split(", ")]
    rows = (row for batch in batches for row in zip(*(batch.column(n) for n in ("a", "b", "side", "own")), strict=True))
    for pair, blocks in groupby(rows, key=lambda row: (row[0].as_py(), row[1].as_py())):
        known: dict[tuple, tuple] = {}
        for _, _, side, block in blocks:
            for doc_id, key, *rest in zip(*(block.values.field(n).to_pylist() for n in ("doc_id", "key", "n", "sketch")), strict=True):
                known.setdefault((side.as_py(), doc_id, key), rest)
        own, (sizes, sketches) = list(known), zip(*known.values(), strict=True)
        split = sum(side == 0 for side, _, _ in own)
        stay = possible(np.array(sizes, np.int64), list(sketches), split if split < len(own) else 0)
        out = [(*pair, *own[k]) for k in np.flatnonzero(stay).tolist()]
        columns = zip(*out, strict=True) if out else ((),) * len(names)
        kinds = (pa.int32() if name == "side" else pa.int64() for name in names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each pair of blocks; rows come sorted by pair and side."""
    rows = (row for batch in batches for row in zip(*(batch.column(n) for n in ("a", "b", "side", "doc_id", "shingles")), strict=True))
    for _, members in groupby(rows, key=lambda row: (row[0].as_py(), row[1].as_py())):
        ids, sets, split = [], [], 0
        for _, _, side, doc_id, values in members:
            split += side.as_py() == 0
            ids.append(doc_id.as_py())
            sets.append(np.frombuffer(values.as_py(), U64))
        links = similar_pieces(ids, sets, split if split < len(sets) else 0)
        yield pa.RecordBatch.from_arrays([pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)], ["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(text) for (text,) in rows_of(batch, "text")]
        made = [[len(x) for x in sets], [sketch(x) for x in sets], [x.tobytes() for x in sets]]
        columns = [*(batch.column(n) for n in ("doc_id", "key", "block")), *(pa.array(x, k) for x, k in zip(made, (pa.int64(), pa.binary(), pa.binary()), strict=True))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "block", "n", "sketch", "shingles"])


def _in_rounds(rows: DataFrame, size: Column, most: int, name: str, meet: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``meet`` of the pairs (a, b) in ``rows``, whose meeting takes ``size`` bytes a row, in rounds of ``most`` bytes."""
    rounds = buckets_for(rows.agg(F.sum(size)).first()[0] or 0, most)
    own = F.pmod(F.xxhash64("a", "b"), F.lit(rounds))
    held = [stage(meet(rows.where(own == k)), name) for k in range(rounds)]
    return reduce(DataFrame.union, held)


def similar_links(keyed: DataFrame, surveyed: DataFrame, most: int) -> DataFrame:
    """Links (a, b: doc ids) that span the groups of similar sets. Nodes stand for the smallest document that has them.
    Sets and sketches that meet take about ``most`` bytes at once."""
    own, nodes = surveyed.where("kind = 0 and doc_id is not null and n > 0"), surveyed.where("kind = 1")
    # Nodes of one home are a block; where they are many, several.
    full = nodes.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).alias("spread")).where("spread > 1")
    part = F.pmod(F.xxhash64("h1"), F.coalesce("spread", F.lit(1)))
    nodes = stage(nodes.join(full, "home", "left").select("h1", "probes", "others", F.xxhash64("home", part).alias("block")), "nodes")
    first = own.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    wanted = nodes.select("h1", "block").join(first, "h1").select(F.col("first.doc_id").alias("own_id"), F.col("first.key").alias("own_key"), "block").distinct()
    members = keyed.join(wanted.hint("shuffle_hash"), F.expr("doc_id = own_id and key = own_key"))
    made = "doc_id long, key long, block long, n long, sketch binary, shingles binary"
    members = stage(members.select("doc_id", "key", "block", "text").mapInArrow(_sets, made), "sets")

    asked = nodes.select("block", F.explode("probes").alias("sig"), F.lit(True).alias("probe"))
    shown = nodes.select("block", F.explode("others").alias("sig"), F.lit(False).alias("probe"))
    blocks = asked.union(shown).groupBy("sig", "block").agg(F.max("probe").alias("probe"), F.count("*").alias("n"))
    blocks = stage(blocks, "blocks")
    x, y = blocks.alias("x"), blocks.alias("y")
    met = x.join(y, F.expr("x.sig = y.sig and x.block < y.block and (x.probe or y.probe)")).select(F.col("x.block").alias("a"), F.col("y.block").alias("b"))
    inside = blocks.where("probe and n > 1").select(F.col("block").alias("a"), F.col("block").alias("b"))
    pairs = stage(met.union(inside).distinct(), "pairs")
    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("a", "b").sortWithinPartitions("a", "b", "side")

    def at_block(rows: DataFrame) -> DataFrame:
        return rows.withColumn("block", F.when(F.col("side") == 0, F.col("a")).otherwise(F.col("b")))

    def sift(rows: DataFrame) -> DataFrame:
        return dealt(rows.drop("bytes").join(sketches.drop("bytes"), "block").drop("block")).mapInArrow(_sift, SIFTED)

    def verify(rows: DataFrame) -> DataFrame:
        met = at_block(rows).join(members.select("block", "doc_id", "key", "shingles"), ["block", "doc_id", "key"])
        return dealt(met.select("a", "b", "side", "doc_id", "shingles")).mapInArrow(_verify, "a long, b long")

    held = F.sum(F.octet_length("sketch") + 48).alias("bytes"), F.collect_list(F.struct("doc_id", "key", "n", "sketch")).alias("own")
    sketches = stage(members.groupBy("block").agg(*held), "sketches")
    both = at_block(pairs.withColumn("side", F.lit(0)).union(pairs.where("a < b").withColumn("side", F.lit(1))))
    sifted = _in_rounds(both.join(sketches.select("block", "bytes"), "block"), F.col("bytes"), most, "sifted", sift)
    sized = at_block(sifted).join(members.select("block", "doc_id", "key", "n").distinct(), ["block", "doc_id", "key"])
    return _in_rounds(sized.select(*sifted.columns, "n"), 8 * F.col("n") + 32, most, "links", verify)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that can be reached over links between sets of similarity 0.75 or more. A
    text without words has an empty set and no links. A null id links with nothing and has a null component. Rows that
    repeat an id are told apart by their texts and share their links.
    """
    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("key", F.xxhash64("text"))
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = buckets_for(size // BYTES_PER_SIGNATURE, TOGETHER)
    sent = keyed.select("doc_id", "key", "text").mapInArrow(_send(buckets), PACKED)
    met = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_meet(buckets), PACKED)
    judged = met.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_judge, SURVEYED)
    surveyed = stage(judged, "surveyed")
    groups = components(similar_links(keyed, surveyed, max(size, LEAST_ROUND))).withColumnRenamed("id", "first")
    own = surveyed.where("kind = 0").select("doc_id", "n", "h1", "h2")
    first = own.where("doc_id is not null and n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
    least = stage(first.join(groups, "first", "left").select("h1", "h2", F.coalesce("component_id", "first").alias("component_id")), "least")
    linked = own.join(least, ["h1", "h2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return linked.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents", doc_id="long", text="string"))


SQL = r"""with recursive t as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
s as materialized (
  select distinct doc_id, array_to_string(words[i : i + 4], ' ') as shingle
  from (select doc_id, words, unnest(range(1, greatest(1, len(words) - 4) + 1)) as i from t where len(words) > 0)),
n as materialized (select doc_id, count(*) as n from s group by doc_id),
met as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
links as materialized (
  select a, b from met join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 75 * (x.n + y.n - shared)),
ways as materialized (select a, b from links union all select b, a from links),
reached(doc_id, other) as (
  select doc_id, doc_id from t union select r.doc_id, w.b from reached r join ways w on w.a = r.other)
select t.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id from t left join n using (doc_id)
join (select doc_id, min(other) as component_id from reached group by doc_id) c using (doc_id)"""
