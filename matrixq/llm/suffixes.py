"""Exact-substring dedup over all texts by suffix order and backward extension.

Every byte under a string of ``length`` bytes that also starts earlier (in a document with a
smaller id, or earlier in the same one) is removed. Strings are judged on the input.

Texts are first reduced to what can repeat. Each window of ``length`` bytes chooses one of its
grams, that with the least hash; equal windows choose equal grams at equal places, so only windows
whose grams are equal have to be compared. Runs of successive windows with the same choice, their
gram's hash and the hash of all bytes under them are shuffled by the gram, packed. Equal runs are
settled by these hashes alone: all but the first go, and of those that are read together only the
first is shuffled. Runs of one gram that are not equal are fetched, brought together and settled by
a Burrows-Wheeler transform of their bytes: intervals of suffixes are extended backward, breadth
first, which gives common prefixes by increasing length and stops at ``length``. Where very many
different runs share a gram, their windows are dealt out one by one by their own hash, so that no
group has to be in one task. The hashes have 64 bits and are combined.

Null texts count as empty. Rows with equal id and text are one document, treated alike; rows with
equal id and other texts are ordered by the place in their text alone. Rows without id come last.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixq.llm import suffix_kernel
from matrixq.llm.common import written
from matrixq.llm.suffix_kernel import Roller, anchors, repeats
from matrixq.session import tune_texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(suffix_kernel)

LENGTH, GRAM = 100, 44
#: Bytes of text per group of documents, and of text whose runs are packed together.
PART_BYTES, READ_BYTES = 8 << 20, 24 << 20
#: Bytes that one transform is made of.
BIN_BYTES = 1 << 20
#: Different runs of one gram; beyond it their windows are dealt out.
CROWD = 5_000

RUN = np.dtype([("gram", "<u8"), ("whole", "<u8"), ("doc", "<i8"), ("body", "<i8"),
                ("first", "<i4"), ("many", "<i4")])
CUT = np.dtype([("doc", "<i8"), ("body", "<i8"), ("first", "<i4"), ("last", "<i4")])
_PACKED = "kind int, part long, data binary"


def _row(kind: int, part: int, data: bytes) -> tuple:
    return kind, part, data


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.binary())], ["kind", "part", "data"],
    )


def _bytes(rows: np.ndarray) -> bytes:
    """Rows by the places of their bytes: what most have in common, as zeros, stands together and
    is packed well in shuffle files."""
    return np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), rows.itemsize).T.tobytes()


def _rows(data: bytes, kind: np.dtype) -> np.ndarray:
    """What ``_bytes`` was given."""
    planes = np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _doc_part(body: np.ndarray, parts: int) -> np.ndarray:
    return body % parts  # never negative, like Spark's pmod


def _pieces(rows: np.ndarray, part: np.ndarray, kind: int) -> Iterator[tuple]:
    """Rows packed by part."""
    order = np.argsort(part, kind="stable")
    rows, part = rows[order], part[order]
    for some in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(part)) + 1):
        if len(some):
            yield _row(kind, int(part[some[0]]), _bytes(rows[some]))


def _first_runs(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs in the order of gram and bytes, and whether an equal run starts earlier."""
    runs = runs[np.lexsort((runs["first"], runs["doc"], runs["whole"], runs["gram"]))]
    heads = np.ones(len(runs), bool)
    heads[1:] = (runs["gram"][1:] != runs["gram"][:-1]) | (runs["whole"][1:] != runs["whole"][:-1])
    head = np.maximum.accumulate(np.where(heads, np.arange(len(runs)), 0))
    later = (runs["doc"] != runs["doc"][head]) | (runs["first"] != runs["first"][head])
    return runs, later


def _merged(cuts: np.ndarray) -> np.ndarray:
    """Intervals of each document joined where they touch or overlap."""
    if not len(cuts):
        return cuts
    cuts = cuts[np.lexsort((cuts["first"], cuts["body"], cuts["doc"]))]
    same = (cuts["doc"][1:] == cuts["doc"][:-1]) & (cuts["body"][1:] == cuts["body"][:-1])
    number = np.concatenate([[0], np.cumsum(~same)])
    # The furthest end so far inside a document: ends are lifted by document to keep them apart.
    lift = number * (1 << 32)
    reach = np.maximum.accumulate(cuts["last"] + lift)
    fresh = np.ones(len(cuts), bool)
    fresh[1:] = ~same | (cuts["first"][1:] + lift[1:] > reach[:-1])
    begin = np.flatnonzero(fresh)
    out = cuts[begin].copy()
    out["last"] = (np.maximum.reduceat(cuts["last"] + lift, begin) - lift[begin]).astype(np.int32)
    return out


def _cuts(runs: np.ndarray, length: int) -> np.ndarray:
    out = np.empty(len(runs), CUT)
    out["doc"], out["body"], out["first"] = runs["doc"], runs["body"], runs["first"]
    out["last"] = runs["first"] + runs["many"] - 1 + length
    return _merged(out)


def _read_runs(length: int, gram: int, parts: int):
    """Documents to packed runs, by gram (kind 0), and first cuts, by document (kind 1)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, held, size = Roller(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                runs, later = _first_runs(np.concatenate(held))
                cuts = _cuts(runs[later], length)
                rest = runs[~later]
                part = (rest["gram"] % np.uint64(parts)).astype(np.int64)
                rows = [*_pieces(rest, part, 0), *_pieces(cuts, _doc_part(cuts["body"], parts), 1)]
                for k in range(0, len(rows), 64):
                    yield _batch(rows[k : k + 64])

        for batch in batches:
            docs, bodies = batch["doc"].to_pylist(), batch["body"].to_pylist()
            for doc, body, text in zip(docs, bodies, batch["text"]):
                raw = np.frombuffer(text.as_buffer(), np.uint8)
                if len(raw) >= length:
                    found = anchors(raw, length, gram, roller)
                    runs = np.empty(len(found[0]), RUN)
                    runs["doc"], runs["body"] = doc, body
                    for name, values in zip(("gram", "whole", "first", "many"), found):
                        runs[name] = values
                    held.append(runs)
                    size += len(raw)
                if size >= READ_BYTES:
                    yield from flush()
                    held, size = [], 0
        yield from flush()

    return read


def _settle_runs(length: int, parts: int):
    """One group: cuts of equal runs, and unequal runs of a gram, both by document. Kind 2 are
    runs to be fetched, kind 3 those of crowded grams."""
    def settle(table: pa.Table) -> pa.Table:
        kinds = table["kind"].to_numpy()
        if (kinds == 1).all():
            return table
        data = [x.as_py() for x, kind in zip(table["data"], kinds) if kind == 0]
        runs, later = _first_runs(np.concatenate([_rows(x, RUN) for x in data]))
        cuts = _cuts(runs[later], length)
        heads = np.ones(len(runs), bool)
        heads[1:] = (runs["gram"][1:] != runs["gram"][:-1]) | (runs["whole"][1:] != runs["whole"][:-1])
        runs = runs[heads]
        _, place, many = np.unique(runs["gram"], return_inverse=True, return_counts=True)
        several, crowded = many[place] > 1, many[place] > CROWD
        asked = [(runs[several & ~crowded], 2), (runs[crowded], 3)]
        rows = [*_pieces(cuts, _doc_part(cuts["body"], parts), 1)]
        for some, kind in asked:
            rows += _pieces(some, _doc_part(some["body"], parts), kind)
        rows += [_row(1, p, d) for k, p, d in zip(kinds, table["part"].to_pylist(),
                                                  table["data"].to_pylist()) if k == 1]
        return pa.Table.from_batches([_batch(rows)])

    return settle


#: A fetched run: its place and length in the bytes that follow.
FETCHED = np.dtype([*RUN.descr, ("at", "<i8"), ("bytes", "<i8")])


def _fetch(length: int, parts: int):
    """Documents of one part and the runs asked of them to runs with their bytes, by gram."""
    def fetch(docs: pa.Table, asks: pa.Table) -> pa.Table:
        if not len(asks):
            return pa.Table.from_batches([_batch([])])
        kinds = asks["kind"].to_pylist()
        wanted = {
            kind: np.concatenate([np.empty(0, RUN)] + [
                _rows(x.as_py(), RUN) for x, k in zip(asks["data"], kinds) if k == kind
            ]) for kind in (2, 3)
        }
        texts = {(d, b): t for d, b, t in zip(docs["doc"].to_pylist(), docs["body"].to_pylist(),
                                              docs["text"])}
        if len(wanted[3]):
            # Of crowded grams each window goes to a part by its own bytes.
            many = wanted[3]["many"]
            each = np.repeat(wanted[3], many)
            ends = np.cumsum(many)
            each["first"] += (np.arange(len(each)) - np.repeat(ends - many, many)).astype(np.int32)
            each["many"] = 1
            roller, last = Roller(), None
            for k in np.lexsort((each["body"], each["doc"])).tolist():
                key = (int(each["doc"][k]), int(each["body"][k]))
                if key != last:
                    sums, last = roller.prefixes(np.frombuffer(texts[key].as_buffer(), np.uint8)), key
                first = np.array([each["first"][k]])
                each["gram"][k] = roller.hashes(sums, first, first + length)[0]
            wanted[2] = np.concatenate([wanted[2], each])
        runs = wanted[2]
        size = runs["many"].astype(np.int64) - 1 + length
        part = (runs["gram"] % np.uint64(parts)).astype(np.int64)
        rows = []
        order = np.argsort(part, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            if not len(some):
                continue
            out = np.empty(len(some), FETCHED)
            for name in RUN.names:
                out[name] = runs[name][some]
            out["bytes"] = size[some]
            out["at"] = np.cumsum(size[some]) - size[some]
            raw = b"".join(
                memoryview(texts[d, b].as_buffer())[f : f + n]
                for d, b, f, n in zip(out["doc"].tolist(), out["body"].tolist(),
                                      out["first"].tolist(), out["bytes"].tolist())
            )
            head = np.int64(len(out)).tobytes()
            rows.append(_row(4, int(part[some[0]]), head + out.tobytes() + raw))
        return pa.Table.from_batches([_batch(rows)])

    return fetch


def _compare(length: int, parts: int):
    """Runs of one part, whole grams together, through the transform; gives cuts by document."""
    def compare(table: pa.Table) -> pa.Table:
        metas, texts = [], []
        for data in table["data"].to_pylist():
            n = int(np.frombuffer(data, np.int64, 1)[0])
            meta = np.frombuffer(data, FETCHED, n, 8)
            raw = np.frombuffer(data, np.uint8, offset=8 + n * FETCHED.itemsize)
            metas.append(meta)
            texts += [raw[a : a + b] for a, b in zip(meta["at"].tolist(), meta["bytes"].tolist())]
        meta = np.concatenate(metas)
        order = np.argsort(meta["gram"], kind="stable")
        meta = meta[order]
        grams = np.concatenate([[0], np.cumsum(meta["gram"][1:] != meta["gram"][:-1])])
        # Bins of whole grams, about equal in bytes.
        before = np.cumsum(meta["bytes"]) - meta["bytes"]
        starts = np.flatnonzero(np.concatenate([[True], np.diff(grams) > 0]))
        number = before[starts][grams] // BIN_BYTES
        cuts = []
        for some in np.split(np.arange(len(meta)), np.flatnonzero(np.diff(number)) + 1):
            own = meta[some]
            segment, window = repeats([texts[k] for k in order[some]], own["many"].astype(np.int64),
                                      own["doc"], own["first"].astype(np.int64), length)
            found = np.empty(len(segment), CUT)
            found["doc"], found["body"] = own["doc"][segment], own["body"][segment]
            found["first"] = own["first"][segment] + window
            found["last"] = found["first"] + length
            cuts.append(_merged(found))
        cuts = np.concatenate(cuts)
        return pa.Table.from_batches([_batch([*_pieces(cuts, _doc_part(cuts["body"], parts), 1)])])

    return compare


def _remove():
    """Documents of one part and the cuts in them to what is left."""
    def remove(docs: pa.Table, cuts: pa.Table) -> pa.Table:
        all_cuts = _merged(np.concatenate(
            [np.empty(0, CUT)] + [_rows(x, CUT) for x in cuts["data"].to_pylist()]
        ))
        keys = list(zip(all_cuts["doc"].tolist(), all_cuts["body"].tolist()))
        spans: dict[tuple, list] = {}
        for key, first, last in zip(keys, all_cuts["first"].tolist(), all_cuts["last"].tolist()):
            spans.setdefault(key, []).append((first, last))
        sizes, removed, numbers, left, starts, ends = [], [], [], [], [], []
        for doc, body, text in zip(docs["doc"].to_pylist(), docs["body"].to_pylist(), docs["text"]):
            raw, own = text.as_py(), spans.get((doc, body), [])
            edges = [0, *(x for span in own for x in span), len(raw)]
            left.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            sizes.append(len(raw))
            removed.append(len(raw) - len(left[-1]))
            numbers.append(len(own))
            starts.append([a for a, _ in own])
            ends.append([b for _, b in own])
        return pa.table({
            "id": docs["id"], "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(numbers, pa.int64()),
            "kept": pa.array(left, pa.binary()), "starts": pa.array(starts, pa.list_(pa.int64())),
            "ends": pa.array(ends, pa.list_(pa.int64())),
        })

    return remove


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
          gram: int = GRAM) -> DataFrame:
    """Rows ``(key, n_bytes, n_removed, n_spans, kept, starts, ends)``: the bytes that are left of
    each text (binary), and the removed spans by their first byte and the one behind the last.
    """
    tune_texts(df.sparkSession)
    gram = min(gram, length)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = df.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
        F.xxhash64(body, F.col(f"`{key}`").cast("long")).alias("body"),
        body.cast("binary").alias("text"),
    )
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    docs = docs.withColumn("part", F.pmod("body", F.lit(parts)).cast("long"))
    read = docs.select("doc", "body", "text").mapInArrow(_read_runs(length, gram, parts), _PACKED)
    settled = written(
        read.groupBy("kind", "part").applyInArrow(_settle_runs(length, parts), _PACKED), "repeats"
    )
    asks = settled.where("kind in (2, 3)")
    # All columns, as for what is left of the texts below: one shuffle of them serves both.
    fetched = (
        docs.groupBy("part")
        .cogroup(asks.groupBy("part")).applyInArrow(_fetch(length, parts), _PACKED)
    )
    compared = fetched.groupBy("part").applyInArrow(_compare(length, parts), _PACKED)
    cuts = settled.where("kind = 1").unionByName(compared)
    done = docs.groupBy("part").cogroup(cuts.groupBy("part")).applyInArrow(
        _remove(), "id long, n_bytes long, n_removed long, n_spans long, kept binary, "
                   "starts array<long>, ends array<long>"
    )
    return done.withColumnRenamed("id", key)
