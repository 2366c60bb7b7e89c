"""Exact substring deduplication by sorting suffixes, deep and shallow.

A string of ``LENGTH`` bytes is told by its *anchor*, the smallest hash among
its k-grams. All starts in a row with one anchor are a *segment*; strings
that are equal lie in segments with the same anchor. So a first pass sends
small digests of segments only. Where all segments of an anchor are equal,
that settles their strings. Where they differ (around the edges of what
texts share), the first document with each of them sends its bytes, and the
suffixes at their starts are sorted: by multikey quicksort to a shallow
depth, and by blind tries where long common prefixes remain.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxloom.llm.common import spread
from fluxloom.session import shared_dir

#: Bytes of the strings that count, and of the k-grams among which anchors are chosen.
LENGTH, GRAM = 50, 20
WINDOW, HALF = LENGTH - GRAM + 1, (LENGTH - GRAM) // 2
#: Bytes of text worked on at a time; a longer text is cut into such blocks, which changes no result.
BLOCK = 1 << 19
#: Bytes of text whose digests one group takes in.
PER_GROUP = 16 << 20
#: Depth of the multikey sort, a multiple of 8.
SHALLOW = 16
#: Different segments of one anchor beyond which their strings are dealt out one by one.
CROWD = 1_000
REMOVED, DIFFERS, MANY = range(3)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Segments:
    """Cuts texts into segments; holds the powers that hashes of substrings need."""

    def __init__(self) -> None:
        n = BLOCK + LENGTH
        self.value = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        self.power, self.inverse = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        self.power[0] = self.inverse[0] = 1
        self.power, self.inverse = np.cumprod(self.power), np.cumprod(self.inverse)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, start, number of starts, anchor (48 bits) and digest of each segment. ``data`` has ``BLOCK`` bytes at most, plus ``LENGTH``."""
        n = len(data)
        if n < LENGTH:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.value[data] * self.power[:n], out=sums[1:])
        grams = small = mixed((sums[GRAM:] - sums[:-GRAM]) * self.inverse[: n - GRAM + 1])
        width = 1
        while 2 * width <= WINDOW:
            small = np.minimum(small[:-width], small[width:])
            width *= 2
        if width < WINDOW:
            small = np.minimum(small[: -(WINDOW - width)], small[WINDOW - width :])
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, offsets[:-1], 1)
        np.add.at(edge, np.maximum(offsets[:-1], offsets[1:] - LENGTH + 1), -1)
        valid = np.cumsum(edge[: n - LENGTH + 1]) > 0
        change = small[1:] != small[:-1]
        opens, closes = valid.copy(), valid.copy()
        opens[1:] &= change | ~valid[:-1]
        closes[:-1] &= change | ~valid[1:]
        start, last = np.flatnonzero(opens), np.flatnonzero(closes)
        digest = mixed((sums[last + LENGTH] - sums[start]) * self.inverse[start] + (last - start).astype(np.uint64) * np.uint64(_BASE))
        sides = self.sides(sums, grams, small[start], start, last)
        row = np.searchsorted(offsets, start, "right") - 1
        return row, start, last - start + 1, mixed(small[start] + np.uint64(1)) >> np.uint64(16), digest & ~np.uint64(0xFFFF) | sides

    def sides(self, sums: np.ndarray, grams: np.ndarray, value: np.ndarray, start: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Two bytes for each segment: of the anchor with ``HALF`` bytes before it, and with as many behind it.

        A string holds the anchor and ``2 * HALF`` bytes around it, so at
        least ``HALF`` on one side: segments that share a string agree in one
        of these bytes, unless it is 0 because the segment is too short there.
        Both are 0 where the anchor's hash occurs more than once.
        """
        step = np.arange(WINDOW)
        early, late = (grams[at[:, None] + step] == value[:, None] for at in (start, last))
        place = start + early.argmax(1)
        once = (early.sum(1) == 1) & (late.sum(1) == 1) & (place == last + late.argmax(1))

        def byte(a: np.ndarray, b: np.ndarray, fits: np.ndarray) -> np.ndarray:
            a, b = np.where(fits, a, 0), np.where(fits, b, 0)
            code = mixed((sums[b] - sums[a]) * self.inverse[a]) >> np.uint64(32)
            return np.where(fits, code % np.uint64(255) + np.uint64(1), np.uint64(0))

        before = byte(place - HALF, place + GRAM, once & (place - start >= HALF))
        behind = byte(place, place + GRAM + HALF, once & (last + LENGTH - place - GRAM >= HALF))
        return before << np.uint64(8) | behind


def blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, place in its text, bytes, offsets``: runs of short texts, or a block of one long text with what its last strings need."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        size = offsets[a + 1] - offsets[a]
        if size > BLOCK:
            for at in range(0, int(size) - LENGTH + 1, BLOCK):
                part = data[offsets[a] + at : min(offsets[a] + at + BLOCK + LENGTH - 1, offsets[a + 1])]
                yield a, at, part, np.array([0, len(part)])
            a += 1
        else:
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + BLOCK, "right")) - 1)
            yield a, 0, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            a = b


def planes(x: np.ndarray, width: int) -> bytes:
    """Numbers as their first bytes, then their second ones and so on: sorted ones compress well."""
    return np.ascontiguousarray(x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].T).tobytes()


def unplaned(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, 8 - width :] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view(">u8")[:, 0].astype(np.uint64)


def digests(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """For each range of anchors what the task's texts have there, each text's equal segments once."""
    cut = Segments()
    held: list[tuple] = []

    def flush() -> Iterator[pa.RecordBatch]:
        ids, anchor, digest = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        names, place = np.unique(ids, return_inverse=True)
        order = np.lexsort([digest, place, anchor])
        anchor, place, digest = anchor[order], place[order], digest[order]
        new = np.ones(len(order), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1]) | (digest[1:] != digest[:-1])
        anchor, place, digest = anchor[new], place[new], digest[new]
        group = (anchor >> np.uint64(16)) * np.uint64(groups) >> np.uint64(32)
        at = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        ends = np.append(at[1:], len(group))
        out = [[], [], [], [], []]
        for s, e in zip(at.tolist(), ends.tolist(), strict=True):
            own, inner = np.unique(place[s:e], return_inverse=True)
            for column, value in zip(out, (int(group[s]), planes(anchor[s:e], 6), digest[s:e].tobytes(), names[own].tobytes(), planes(inner.astype(np.uint64), 3)), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), *[pa.array(x, pa.binary()) for x in out[1:]]], ["part", "anchors", "digests", "ids", "owners"])

    rows = 0
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for a, _, data, offsets in blocks(batch.column(1)):
            row, _, _, anchor, digest = cut.of(data, offsets)
            if len(row):
                held.append((ids[a + row], anchor, digest))
                rows += len(row)
            if rows > 1_000_000:
                yield from flush()
                rows = 0
    if held:
        yield from flush()


def compare(table: pa.Table) -> pa.Table:
    """What documents must know of one range of anchors: ``doc_id, code``, the code being four times the anchor plus a kind.

    Of equal segments all documents but the first get ``REMOVED``: every
    string in it starts in a smaller one. The first of them gets ``DIFFERS``
    if the anchor has other segments too, which may hold some of its strings;
    ``MANY`` if it has more than ``CROWD`` of them.
    """
    ids, anchors, found = [], [], []
    for _, anchor, digest, names, owners in zip(*[c.to_pylist() for c in table.columns], strict=True):
        anchors.append(unplaned(anchor, 6))
        found.append(np.frombuffer(digest, np.uint64))
        ids.append(np.frombuffer(names, np.int64)[unplaned(owners, 3).astype(np.int64)])
    ids, anchors, found = (np.concatenate(x) for x in (ids, anchors, found))
    order = np.lexsort([ids, found, anchors])
    ids, anchors, found = ids[order], anchors[order], found[order]
    opens = np.concatenate([[True], anchors[1:] != anchors[:-1]])
    kinds = opens.copy()
    kinds[1:] |= found[1:] != found[:-1]
    at = np.flatnonzero(opens)
    several = np.repeat(np.add.reduceat(kinds.astype(np.int64), at), np.diff(np.append(at, len(anchors))))
    first = ids == ids[np.maximum.accumulate(np.where(kinds, np.arange(len(ids)), 0))]
    # Of the different segments of an anchor only those can share a string that agree on a side.
    one = np.flatnonzero(kinds & (several > 1))
    unclear = found[one] & np.uint64(0xFFFF) == 0
    # Documents are told of anchors, so one with several segments of an anchor must have them compared as well.
    part = np.flatnonzero(several > 1)
    part = part[np.lexsort([found[part], ids[part], anchors[part]])]
    again = (anchors[part[1:]] == anchors[part[:-1]]) & (ids[part[1:]] == ids[part[:-1]]) & (found[part[1:]] != found[part[:-1]])
    meets = np.isin(anchors[one], np.concatenate([anchors[one][unclear], anchors[part[1:]][again]]))
    for side in (found[one] >> np.uint64(8) & np.uint64(0xFF), found[one] & np.uint64(0xFF)):
        _, which, n = np.unique(anchors[one] << np.uint64(8) | side, return_inverse=True, return_counts=True)
        meets |= (side > 0) & (n[which] > 1)
    sends = np.zeros(len(ids), bool)
    sends[one] = meets
    sends = sends[np.maximum.accumulate(np.where(kinds, np.arange(len(ids)), 0))]
    tell = ~first | sends
    kind = np.where(~first, REMOVED, np.where(several > CROWD, MANY, DIFFERS))[tell]
    code = (anchors[tell] << np.uint64(2) | kind.astype(np.uint64)).astype(np.int64)
    pair = np.unique(np.stack([ids[tell], code], 1), axis=0)
    # A document with several segments of an anchor sends them all if it must send one.
    last = np.ones(len(pair), bool)
    last[:-1] = (pair[1:, 0] != pair[:-1, 0]) | (pair[1:, 1] >> 2 != pair[:-1, 1] >> 2)
    pair = pair[last]
    return pa.table({"doc_id": pair[:, 0], "code": pair[:, 1]})


def covered(n: int, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which of ``n`` bytes lie in a string that starts at one of the runs of starts."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + counts + LENGTH - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def summary(data: np.ndarray, gone: np.ndarray) -> tuple:
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if gone.size else 0
    kept = hashlib.sha256(data[~gone].tobytes() if spans else data).hexdigest()
    return int(gone.sum()), spans, kept


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
HELD = f"{RESULT}, text binary, starts binary, segments array<struct<anchor:long,start:long,content:binary>>"


def settle_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finish the texts whose segments are all settled; of the others keep the text, what is removed so far, and the segments that differ."""
    cut = Segments()
    empty = np.zeros(0, np.int64)
    for batch in batches:
        ids, texts, codes = batch.columns
        rows: dict[int, list] = {}
        for a, at, data, offsets in blocks(texts):
            row, start, count, anchor, _ = cut.of(data, offsets)
            bounds = np.searchsorted(row, np.arange(len(offsets)))
            for k in range(len(offsets) - 1):
                told = codes[a + k]
                out = rows.setdefault(a + k, [[], [], []])
                if not told.is_valid or bounds[k] == bounds[k + 1]:
                    continue
                told = told.values.to_numpy().astype(np.uint64)
                own = slice(bounds[k], bounds[k + 1])
                kind, told = told & np.uint64(3), told >> np.uint64(2)
                gone = np.isin(anchor[own], told[kind == REMOVED])
                out[0].append(start[own][gone] - offsets[k] + at)
                out[1].append(count[own][gone])
                differ = np.isin(anchor[own], told[kind != REMOVED]) & ~gone
                many = np.isin(anchor[own], told[kind == MANY])
                for s, c, h, m in zip(*(x[differ].tolist() for x in (start[own], count[own], anchor[own], many)), strict=True):
                    if not m:
                        out[2].append({"anchor": h, "start": s - int(offsets[k]) + at, "content": data[s : s + c + LENGTH - 1].tobytes()})
                        continue
                    for one in range(s, s + c):
                        content = data[one : one + LENGTH].tobytes()
                        key = int.from_bytes(hashlib.blake2b(content, digest_size=7).digest(), "big")
                        out[2].append({"anchor": key, "start": one - int(offsets[k]) + at, "content": content})
        out = [[] for _ in range(8)]
        for k in range(batch.num_rows):
            starts, counts, segments = rows.get(k, [[], [], []])
            data = np.frombuffer(texts[k].as_py() or b"", np.uint8)
            starts, counts = np.concatenate([empty, *starts]), np.concatenate([empty, *counts])
            if segments:
                line = (None, None, None, data.tobytes(), np.stack([starts, counts]).tobytes(), segments)
            else:
                line = (*summary(data, covered(len(data), starts, counts)), None, None, None)
            for column, value in zip(out, (ids[k].as_py(), len(data), *line), strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.struct([("anchor", pa.int64()), ("start", pa.int64()), ("content", pa.binary())]))]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "starts", "segments"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)


def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [[] for _ in range(5)]
        for doc_id, text, starts, more in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            data = np.frombuffer(text, np.uint8)
            starts, counts = np.frombuffer(starts, np.int64).reshape(2, -1)
            more = np.array(more or [], np.int64)
            gone = covered(len(data), np.concatenate([starts, more]), np.concatenate([counts, np.ones(len(more), np.int64)]))
            for column, value in zip(out, (doc_id, len(data), *summary(data, gone)), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in out[:4]], pa.array(out[4], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )


def blind_trie(data: bytes, places: list[int], depth: int) -> list[list[int]]:
    """Sort suffixes that agree in their first ``depth`` bytes; those equal in ``LENGTH`` bytes come together.

    A node is ``[place of the branching byte, {byte: child}, a suffix below]``,
    a leaf a list of suffixes. The way down looks at branching bytes only; one
    comparison with the leaf that is reached tells where the suffix differs.
    """
    leaf: dict[int, list[int]] = {places[0]: [places[0]]}
    top: object = places[0]
    for p in places[1:]:
        node = top
        while isinstance(node, list):
            node = node[1].get(data[p + node[0]], node[2])
        apart = int.from_bytes(data[p + depth : p + LENGTH], "big") ^ int.from_bytes(data[node + depth : node + LENGTH], "big")
        if not apart:
            leaf[node].append(p)
            continue
        leaf[p] = [p]
        common = LENGTH - (apart.bit_length() + 7) // 8
        above, node_at = None, top
        while isinstance(node_at, list) and node_at[0] < common:
            above, node_at = node_at, node_at[1][data[p + node_at[0]]]
        if isinstance(node_at, list) and node_at[0] == common:
            node_at[1][data[p + common]] = p
        else:
            branch = [common, {data[node + common]: node_at, data[p + common]: p}, node]
            if above is None:
                top = branch
            else:
                above[1][data[p + above[0]]] = branch
    out, stack = [], [top]
    while stack:
        node = stack.pop()
        if isinstance(node, list):
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
        else:
            out.append(leaf[node])
    return out


def sorted_groups(data: np.ndarray, places: np.ndarray) -> Iterator[np.ndarray]:
    """Suffixes in order, those equal in ``LENGTH`` bytes together."""
    words = np.zeros(len(data) + LENGTH, np.uint64)
    padded = np.concatenate([data, np.zeros(LENGTH + 8, np.uint8)]).astype(np.uint64)
    for k in range(8):
        words |= padded[k : k + len(words)] << np.uint64(56 - 8 * k)
    # Multikey: by the first word; where that ties by the next; and so on to the shallow depth.
    order = places[np.argsort(words[places], kind="stable")]
    tied = np.concatenate([[False], words[order[1:]] == words[order[:-1]]])
    for depth in range(8, SHALLOW, 8):
        group = np.cumsum(~tied)
        again = np.flatnonzero(tied | np.append(tied[1:], False))
        inner = np.lexsort([words[order[again] + depth], group[again]])
        order[again] = order[again][inner]
        tied[1:] &= words[order[1:] + depth] == words[order[:-1] + depth]
    whole = data.tobytes()
    at = np.flatnonzero(~tied)
    for s, e in zip(at.tolist(), np.append(at[1:], len(order)).tolist(), strict=True):
        if e - s == 1:
            yield order[s:e]
        else:
            yield from (np.array(g) for g in blind_trie(whole, order[s:e].tolist(), SHALLOW))


def sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The starts at which a document has a string that a smaller one has too: ``doc_id, start``.

    Rows come sorted by anchor; whole anchors are sorted together, some
    megabytes at a time.
    """

    def flush(held: list[tuple]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(c for _, _, c, _ in held), np.uint8)
        lengths = np.array([len(c) for _, _, c, _ in held])
        begin = np.cumsum(lengths) - lengths
        counts = lengths - LENGTH + 1
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        places = np.repeat(begin, counts) + inner
        doc, start = np.zeros(len(data), np.int64), np.zeros(len(data), np.int64)
        doc[places] = np.repeat(np.array([d for _, _, _, d in held], np.int64), counts)
        start[places] = np.repeat(np.array([s for _, s, _, _ in held], np.int64), counts) + inner
        least = doc.copy()
        for group in sorted_groups(data, places):
            if len(group) > 1:
                least[group] = doc[group].min()
        gone = places[least[places] < doc[places]]
        return pa.RecordBatch.from_arrays([pa.array(doc[gone]), pa.array(start[gone])], ["doc_id", "start"])

    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if size > BLOCK and row[0] != held[-1][0]:
                yield flush(held)
                held, size = [], 0
            held.append(row)
            size += len(row[2])
    if held:
        yield flush(held)


def by_document(df: DataFrame) -> DataFrame:
    """Write ``df`` in buckets of doc_id below the shared folder, so that a later join by doc_id doesn't move the texts again."""
    spark = df.sparkSession
    name = f"settled_{uuid.uuid4().hex}"
    folder = f"{shared_dir(spark)}/fluxloom/{name}"
    df.write.bucketBy(spread(spark), "doc_id").option("path", folder).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def dedup(docs: DataFrame) -> DataFrame:
    """What stays of each text when bytes covered by an earlier document's ``LENGTH``-byte strings go.

    Result: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per
    row of ``docs``. Texts are UTF-8 bytes; a string counts if it also starts
    in a document with a smaller doc_id; strings overlap and are judged on the
    input. Matches never cross documents.

    NULL and empty texts have no bytes. Rows that share a doc_id don't remove
    from each other. Rows with NULL doc_id have no order: they lose nothing
    and cause nothing. Other columns don't matter; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(spread(spark), int(total) // PER_GROUP)
    sent = texts.where("doc_id is not null").mapInArrow(lambda it: digests(it, groups), "part long, anchors binary, digests binary, ids binary, owners binary")
    told = sent.groupBy("part").applyInArrow(compare, "doc_id long, code long")
    told = told.groupBy("doc_id").agg(F.collect_list("code").alias("codes"))
    held = by_document(texts.join(told, "doc_id", "left").mapInArrow(settle_equal, HELD))
    open_ones = held.where("segments is not null")
    segments = open_ones.select(F.explode("segments").alias("s"), "doc_id").select("s.anchor", "s.start", "s.content", "doc_id")
    ordered = segments.repartition(spread(spark), "anchor").sortWithinPartitions("anchor")
    more = ordered.mapInArrow(sort_suffixes, "doc_id long, start long")
    more = more.groupBy("doc_id").agg(F.collect_list("start").alias("more"))
    rest = open_ones.join(more, "doc_id", "left").select("doc_id", "text", "starts", "more").mapInArrow(finish, RESULT)
    return held.where("segments is null").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").unionByName(rest)
