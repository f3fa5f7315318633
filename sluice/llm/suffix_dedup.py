"""Repeated strings of a corpus, found by run-compressed suffix indexes of the passages that may repeat.

Every window of `length` bytes names a short gram inside it by content alone, so equal windows name equal grams at
equal places. Windows of one gram in a row are a passage. Passages whose gram stands nowhere else cannot repeat; of the
others, equal ones become one with a count. The different passages of a gram meet in one index. A gram in very many
different passages is cut into finer groups first, by the bytes that all windows of a band of offsets have in common; equal
pieces of a group become one with a count again, and a group that still has very many different pieces is cut into single
windows, which are counted. The index sorts their suffixes, keeps samples at the run ends of the transform, and streams matching statistics, which say
of each window whether it stands elsewhere. Marked windows return to their documents, where their bytes go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import anchors, common, flat, run_index

TASK_BYTES = 16 << 20
#: Bytes of passages that are indexed together, different passages of a gram that are cut finer, offsets of a band.
INDEX_BYTES, FORMS, BAND = 1 << 18, 8192, 16
ASK, WITNESS, KNOWN = 0, 1, 2

FOUND = pa.schema(
    [("kind", pa.int32()), ("deal", pa.int64()), ("rid", pa.int32()), ("did", pa.int64()), ("first", pa.int64()),
     ("size", pa.int32()), ("gram", pa.int64()), ("body", pa.int64())]
)
FOUND_DDL = "kind int, deal bigint, rid int, did bigint, first bigint, size int, gram bigint, body bigint"


def named_passages(length: int):
    """Passages of each text; those whose gram comes again in the batch are known to repeat it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat.buffers(batch.column("text"))
            rid, did = batch.column("rid").to_numpy(), batch.column("did").to_numpy()
            found = []
            for row, byte, borders in anchors.pieces(at, length):
                own, first, size, gram, body = anchors.runs(data[borders[0] : borders[-1]], borders - borders[0], length)
                found.append((own + row, first + byte, size, gram, body))
            if not found:
                continue
            row, first, size, gram, body = (np.concatenate(x) for x in zip(*found, strict=True))
            if not len(row):
                continue
            _, one, group, count = np.unique(gram, return_index=True, return_inverse=True, return_counts=True)
            known = count[group] > 1
            witness = one[count > 1]
            gram, body = gram.view(np.int64), body.view(np.int64)
            spread = flat.mix((did[row] + first).astype(np.uint64)).view(np.int64)
            yield common.record(
                FOUND, kind=np.where(known, KNOWN, ASK).astype(np.int32), deal=np.where(known, spread, gram), rid=rid[row], did=did[row],
                first=first - at[row], size=size.astype(np.int32), gram=gram, body=body,
            )
            zero = np.zeros(len(witness), np.int64)
            yield common.record(FOUND, kind=np.full(len(witness), WITNESS, np.int32), deal=gram[witness], rid=zero.astype(np.int32), did=zero, first=zero, size=zero.astype(np.int32), gram=gram[witness], body=zero)

    return work


def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of `deal`, those known, and those whose gram comes more than once."""
    carry: pa.RecordBatch | None = None
    repeated_before = False
    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        if len(known := np.flatnonzero(kinds == KNOWN)):
            yield batch.take(pa.array(known))
        batch = batch.take(pa.array(np.flatnonzero(kinds != KNOWN)))
        if not len(batch):
            continue
        if carry is not None:
            batch = pa.Table.from_batches([carry, batch]).combine_chunks().to_batches()[0]
        gram, kinds = batch.column("gram").to_numpy(), batch.column("kind").to_numpy()
        many = np.zeros(len(gram), bool)
        same = gram[1:] == gram[:-1]
        many[1:] |= same
        many[:-1] |= same
        if repeated_before:
            many |= gram == gram[0]
        last_many = bool(many[-1])
        out = many & (kinds == ASK)
        if carry is not None and repeated_before:
            out[0] = False
        if len(rows := np.flatnonzero(out)):
            yield batch.take(pa.array(rows))
        # The last row stands for its gram in the next batch; it was given out if it repeats.
        carry, repeated_before = batch.slice(len(batch) - 1, 1), last_many


BODIES = pa.schema([("deal", pa.int64()), ("gram", pa.int64()), ("body", pa.int64()), ("start", pa.int32()), ("size", pa.int32()), ("times", pa.int64()), ("passage", pa.binary())])
#: The same of pieces in bands, with a hash of the bytes of each.
PIECES = BODIES.append(pa.field("piece", pa.int64()))
BODIES_DDL = "deal bigint, gram bigint, body bigint, start int, size int, times bigint, passage binary"
PIECES_DDL = BODIES_DDL + ", piece bigint"


def named(raw: bytes) -> int:
    """A 64-bit name of some bytes."""
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def passages_of(length: int):
    """The bytes of the chosen passages of each text. Those of a very frequent gram are cut into bands of windows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat.buffers(batch.column("text"))
            out: list[tuple] = []
            for i, picks in enumerate(batch.column("picks")):
                raw = data[at[i] : at[i + 1]].tobytes()
                for p in picks.as_py():
                    first, size = p["first"], p["size"]
                    if not p["fine"]:
                        out.append((p["gram"], p["gram"], p["body"], 0, size, p["times"], raw[first : first + size + length - 1], p["body"]))
                        continue
                    covered = np.frombuffer(raw[first : first + size + length - 1], np.uint8)
                    gram = flat.range_hash(flat.prefix_hash(covered, flat.BYTES), g := np.arange(len(covered) - anchors.GRAM + 1), g + anchors.GRAM)
                    place = int(np.flatnonzero(gram.view(np.int64) == p["gram"])[0])
                    start = 0
                    while start < size:
                        band = (place - start) // BAND
                        stop = min(size, place - band * BAND + 1)
                        core = raw[first + place - band * BAND : first + place - band * BAND - BAND + 1 + length]
                        deal = named(core + b"%d:%d" % (p["gram"], band))
                        part = raw[first + start : first + stop + length - 1]
                        out.append((deal, p["gram"], p["body"], start, stop - start, p["times"], part, named(part + b"%d" % (place - start))))
                        start = stop
                if len(out) > 2000:
                    yield common.record(PIECES, **dict(zip(PIECES.names, zip(*out, strict=True), strict=True)))
                    out = []
            if out:
                yield common.record(PIECES, **dict(zip(PIECES.names, zip(*out, strict=True), strict=True)))

    return work


WINDOWS = pa.schema([("deal", pa.int64()), ("piece", pa.int64()), ("start", pa.int32()), ("window", pa.int64()), ("times", pa.int64())])
WINDOWS_DDL = "deal bigint, piece bigint, start int, window bigint, times bigint"


def windows_of(length: int):
    """The single windows of each piece. Equal windows stand at one place of one gram, so they are of one deal."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for deal, piece, size, times, raw in zip(*(batch.column(c).to_pylist() for c in ("deal", "piece", "size", "times", "passage")), strict=True):
                out += [(deal, piece, i, named(raw[i : i + length]), times) for i in range(size)]
            if out:
                yield common.record(WINDOWS, **dict(zip(WINDOWS.names, zip(*out, strict=True), strict=True)))

    return work


MARKED = pa.schema([("gram", pa.int64()), ("body", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])


def marked(length: int):
    """Ranges of windows of each passage that stand elsewhere, from one index of whole groups after another."""

    def ranges(held: list[tuple]) -> pa.RecordBatch:
        best, begin = run_index.matching_statistics([x[5] for x in held])
        size = np.array([x[3] for x in held])
        window = np.zeros(len(best) + 1, np.int8)
        often = best >= length
        for i, x in enumerate(held):
            window[begin[i] : begin[i] + size[i]] = 1 if x[4] > 1 else often[begin[i] : begin[i] + size[i]]
        edge = np.diff(window, prepend=0)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        of = np.searchsorted(begin, first, "right") - 1
        shift = np.array([x[2] for x in held])[of] - begin[of]
        return common.record(MARKED, gram=[held[i][0] for i in of], body=[held[i][1] for i in of], start=(first + shift).astype(np.int32), stop=(last + shift).astype(np.int32))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now, volume = None, 0
        for batch in batches:
            for deal, *row in zip(*(batch.column(f.name).to_pylist() for f in BODIES), strict=True):
                if deal != now and volume >= INDEX_BYTES:
                    yield ranges(held)
                    held, volume = [], 0
                now = deal
                held.append(tuple(row))
                volume += len(row[-1]) + 1
        if held:
            yield ranges(held)

    return work


MARKED_DDL = "gram bigint, body bigint, start int, stop int"


def marked_in_bands(cut: DataFrame, length: int, pieces: int) -> DataFrame:
    """Ranges of windows that stand elsewhere, of passages cut into bands.

    Equal pieces are one with a count before they are dealt, so a deal holds different ones only. Where these are still
    too many for an index, equal windows are counted instead; counts are combined before the exchange, so no task
    receives a group as large as its passage is frequent.
    """
    cut = common.keep(cut, "repeat-pieces")
    once = cut.groupBy("deal", "piece").agg(F.first("size").alias("size"), F.sum("times").alias("times"), F.first("passage").alias("passage"))
    once = common.keep(once, "repeat-bands")
    deals = once.groupBy("deal").agg(F.count("*").alias("different"))
    once = once.join(deals, "deal")
    few = once.where(F.col("different") <= FORMS)
    few = few.select("deal", F.col("deal").alias("gram"), F.col("piece").alias("body"), F.lit(0).alias("start"), "size", "times", "passage")
    few = few.repartition(pieces, "deal").sortWithinPartitions("deal").mapInArrow(marked(length), MARKED_DDL)
    few = few.select(F.col("gram").alias("deal"), F.col("body").alias("piece"), F.col("start").alias("from"), "stop")
    many = once.where(F.col("different") > FORMS).select("deal", "piece", "size", "times", "passage").mapInArrow(windows_of(length), WINDOWS_DDL)
    again = many.groupBy("deal", "window").agg(F.sum("times").alias("all")).where("all > 1").select("deal", "window")
    many = many.join(again, ["deal", "window"]).select("deal", "piece", F.col("start").alias("from"), (F.col("start") + 1).alias("stop"))
    out = cut.select("deal", "piece", "gram", "body", "start").join(few.union(many), ["deal", "piece"])
    return out.select("gram", "body", (F.col("start") + F.col("from")).alias("start"), (F.col("start") + F.col("stop")).alias("stop"))


CUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def cut(length: int, with_bytes: bool):
    """Each text without the bytes that its marked windows cover."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat.buffers(batch.column("text"))
            spans = batch.column("spans")
            out: list[tuple] = []
            for i in range(len(batch)):
                raw = data[at[i] : at[i + 1]]
                removed, runs = 0, 0
                if spans[i].is_valid:
                    packed = np.sort(spans[i].values.to_numpy())
                    first, last = packed >> 20, (packed >> 20) + (packed & ((1 << 20) - 1)) + length - 1
                    reach = np.maximum.accumulate(last)
                    fresh = np.ones(len(first), bool)
                    fresh[1:] = first[1:] > reach[:-1]
                    first, last = first[fresh], reach[np.append(np.flatnonzero(fresh)[1:] - 1, len(reach) - 1)]
                    removed, runs = int((last - first).sum()), len(first)
                    kept = np.concatenate([raw[a:b] for a, b in zip(np.append(0, last), np.append(first, len(raw)), strict=True)])
                else:
                    kept = raw
                kept = kept.tobytes()
                out.append((len(raw), removed, runs, hashlib.sha256(kept).hexdigest(), kept if with_bytes else None))
            columns = dict(zip(CUT.names[1:], zip(*out, strict=True), strict=True)) if out else {n: [] for n in CUT.names[1:]}
            batch_out = common.record(CUT, doc_id=batch.column("doc_id"), **columns)
            yield batch_out if with_bytes else batch_out.drop_columns(["kept"])

    return work


def suffix_dedup(documents: DataFrame, length: int = 200, with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row of `documents` (doc_id, text), and `kept` if asked for.

    Every byte is removed that lies in a string of `length` bytes which also starts anywhere else, in the same or
    another row. A null or empty text has no bytes; a text shorter than `length` loses nothing. Repeated rows are documents
    of their own, so each repeats the other. A row may have no doc_id. An empty table gives an empty result.
    """
    doc_id, text = F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    # A row is named by its id (or a hash of its text) and a hash of its text, whose last bit says that it has no id.
    no_id = doc_id.isNull().cast("int")
    docs = documents.select(F.coalesce(doc_id, F.xxhash64(text)).alias("did"), F.hash(text).bitwiseAND(-2).bitwiseOR(no_id).alias("rid"), text.alias("text"))
    pieces = common.parts(docs, TASK_BYTES)
    found = docs.mapInArrow(named_passages(length), FOUND_DDL)
    found = found.repartition(pieces, "deal").sortWithinPartitions("deal", "kind").mapInArrow(settled, FOUND_DDL)
    found = common.keep(found.select("rid", "did", "first", "size", "gram", "body"), "repeat-passages")

    one = [F.first(c).alias(c) for c in ("rid", "did", "first", "size")]
    forms = found.groupBy("gram", "body").agg(F.count("*").alias("times"), *one)
    forms = common.keep(forms, "repeat-forms")
    counted = forms.join(forms.groupBy("gram").agg(F.count("*").alias("forms")), "gram")
    # Equal passages are one with a count; where a gram has no other passage, there is nothing to index.
    alone = counted.where("forms = 1").select("gram", "body", F.lit(0).alias("start"), F.col("size").alias("stop"))
    picks = counted.where("forms > 1").withColumn("fine", F.col("forms") > FORMS)
    dealt = docs.repartition(pieces, "rid", "did")

    def bodies(chosen: DataFrame) -> DataFrame:
        own = chosen.groupBy("rid", "did").agg(F.collect_list(F.struct("gram", "body", "times", "first", "size", "fine")).alias("picks"))
        return dealt.join(own, ["rid", "did"]).select("text", "picks").mapInArrow(passages_of(length), PIECES_DDL)

    whole = bodies(picks.where("not fine")).drop("piece").repartition(pieces, "deal").sortWithinPartitions("deal")
    marks = whole.mapInArrow(marked(length), MARKED_DDL).union(alone)
    if not picks.where("fine").isEmpty():
        marks = marks.union(marked_in_bands(bodies(picks.where("fine")), length, pieces))

    spans = found.join(marks, ["gram", "body"])
    packed = F.shiftleft(F.col("first") + F.col("start"), 20).bitwiseOR((F.col("stop") - F.col("start")).cast("bigint"))
    spans = spans.select("rid", "did", packed.alias("span")).groupBy("rid", "did").agg(F.collect_list("span").alias("spans"))
    # The same exchange of the texts as above.
    own = F.when(F.col("rid").bitwiseAND(1) == 0, F.col("did"))
    out = dealt.join(spans, ["rid", "did"], "left").select(own.alias("doc_id"), "text", "spans")
    ddl = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if with_bytes else "")
    return out.mapInArrow(cut(length, with_bytes), ddl)
