"""Line dedup by content-defined line chunks.

A text is cut into lines; a line of `WRAP` words or more is a paragraph and is
wrapped into lines of its own, after words whose hash is 0 modulo 8. A rolling
hash over two line hashes has its local minima at places that depend on the
lines nearby only: chunks end there, so boundaries resist shifts (two lines at
least, three on average), and at the edges of wrapped paragraphs, whose chunks
therefore depend on the paragraph alone.

A passage of a few short lines between differing ones may hold no whole chunk,
so a line of fewer than `WRAP` words also forms a chunk with the line before it
and one with the line after it: the finest scale, whose boundaries depend on the
two lines alone. Chunks of this scale overlap, so a repeated run of any length
goes from its first line to its last.

A chunk of two or more lines, or a whole paragraph, of `MIN_WORDS` words or
more that occurs more than once anywhere is kept at its first occurrence (by
document id, then position) and removed elsewhere. Candidates come from keys
summed over all documents; the bytes of every candidate are then compared
(grouped by key and bytes), and a key whose occurrences differ in any byte is
left alone. A removed line stands in an earlier occurrence of its chunk, and if
it goes there too, in one earlier still: every line stays somewhere. Between
removed runs nothing changes: the remaining lines keep their bytes.

Work per step is one narrow row per chunk; hot chunks are aggregated by task.
Null texts stay null, empty ones empty. A null id sorts first. Rows with equal
id and text are one document and get the same result. Single short lines, however
frequent, and chunks below MIN_WORDS are never removed. A text all of whose
lines go becomes empty. Columns of the input named `removed_chunks` or
`removed_bytes` are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_column, BYTE, key_filter, may_hold, mix, pieces, released, span_hashes, stored, text_bytes, U64, word_hashes

WRAP = 24
MIN_WORDS = 8
_B2 = mix(BYTE)


def lines_of(buf: np.ndarray, off: np.ndarray):
    """Lines that hold words, as arrays: of words their hash, start, end and
    document; of lines the first word, the word after the last, the group (a
    wrapped paragraph or the run of short lines between two of them, within one
    document), the physical line; and of physical lines whether they are paragraphs."""
    h, start, end, w = word_hashes(buf, off)
    n = len(h)
    if not n:
        return None
    doc = np.repeat(np.arange(len(off) - 1), np.diff(w))
    breaks = np.cumsum(buf == 10)
    row = breaks[start]  # physical line, numbered through
    new_row = np.concatenate(([True], (row[1:] != row[:-1]) | (doc[1:] != doc[:-1])))
    row_id = np.cumsum(new_row) - 1
    long_row = np.bincount(row_id) >= WRAP
    is_long = long_row[row_id]
    cut = np.zeros(n, bool)
    cut[1:] = is_long[1:] & ~new_row[1:] & (h[:-1] % U64(8) == 0)
    at = np.flatnonzero(new_row | cut)
    r = row_id[at]
    new_group = np.concatenate(([True], (doc[at][1:] != doc[at][:-1]) | ((r[1:] != r[:-1]) & (long_row[r[1:]] | long_row[r[:-1]]))))
    return h, start, end, doc, at, np.append(at[1:], n), np.cumsum(new_group) - 1, r, long_row


def _extents(buf: np.ndarray, off: np.ndarray, start, end, doc, a, b):
    """Bytes [lo, hi) removed with each line. A line begins where the one before
    it ends: after its line break, or at its first word if wrapped."""
    lo = start[a].copy()
    first_of_doc = np.concatenate(([True], doc[a][1:] != doc[a][:-1]))
    nl = np.flatnonzero(buf == 10)
    k = np.searchsorted(nl, lo) - 1
    line_start = np.where(k >= 0, nl[np.maximum(k, 0)] + 1 if len(nl) else 0, 0)
    prev_end = np.concatenate(([0], end[b - 1][:-1]))
    lo = np.where(line_start >= prev_end, np.maximum(line_start, 0), lo)
    lo = np.where(first_of_doc, off[doc[a]], np.maximum(lo, off[doc[a]]))
    return lo, np.where(np.concatenate((first_of_doc[1:], [True])), off[doc[a] + 1], np.concatenate((lo[1:], [0])))


def chunks(buf: np.ndarray, off: np.ndarray):
    """Content-defined chunks of the documents: arrays doc, lo, hi (bytes removed
    with the chunk), first, last (bytes compared), for those long enough to count."""
    got = spans(buf, off)
    return None if got is None else got[0]


def spans(buf: np.ndarray, off: np.ndarray):
    """(content-defined chunks, pairs of neighbouring lines), each as in `chunks`."""
    got = lines_of(buf, off)
    if got is None:
        return None
    _, start, end, doc, a, b, group, row, long_row = got
    lo, hi = _extents(buf, off, start, end, doc, a, b)
    lh = span_hashes(buf, start[a], end[b - 1], BYTE)
    same_prev = np.concatenate(([False], group[1:] == group[:-1]))
    prev = np.where(same_prev, np.concatenate((lh[:1], lh[:-1])), U64(0))
    r = mix(lh + prev * U64(31))
    last = np.concatenate((group[1:] != group[:-1], [True]))
    r_prev = np.where(same_prev, np.concatenate((r[:1], r[:-1])), U64(0))  # no end after a group's first line
    r_next = np.concatenate((r[1:], r[-1:]))
    before_last = np.concatenate((last[1:], [True]))                      # nor just before its last
    ends = last | ((r < r_prev) & (r <= r_next) & ~before_last)
    stop = np.flatnonzero(ends)
    begin = np.concatenate(([0], stop[:-1] + 1))
    words = b[stop] - a[begin]
    keep = ((stop - begin >= 1) & (words >= MIN_WORDS)) | (words >= WRAP)  # a paragraph that wraps nowhere counts too
    # the finest scale: physical lines x and x + 1 of one document, not both paragraphs
    head = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))   # a physical line's first line
    tail = np.append(head[1:], len(row)) - 1                               # and its last
    x = np.flatnonzero((doc[a[head[1:]]] == doc[a[head[:-1]]]) & ~(long_row[1:] & long_row[:-1]) & (b[tail[1:]] - a[head[:-1]] >= MIN_WORDS))
    return tuple((doc[a[f]], lo[f], hi[t], start[a[f]], end[b[t] - 1]) for f, t in ((begin[keep], stop[keep]), (head[x], tail[x + 1])))


def _chunk_rows(buf: np.ndarray, off: np.ndarray):
    for i, j in pieces(off):
        part, base = buf[off[i]:off[j]], off[i:j + 1] - off[i]
        for scale, (doc, lo, hi, first, last) in enumerate(spans(part, base) or ()):
            if len(doc):
                k1 = span_hashes(part, first, last, BYTE)
                k2 = mix(k1 + U64(1)) if scale else span_hashes(part, first, last, _B2)
                yield part, i + doc, lo - base[doc], hi - base[doc], first, last, k1.view(np.int64), k2.view(np.int64)


def find_chunks(docs: DataFrame, id_col: str, text: str, row_id: str) -> DataFrame:
    """(k1, k2, id, rid, lo, hi): one row per chunk that counts."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(row_id).alias("rid"), text_bytes(text).alias("b"))

    def run(batches):
        for b in batches:
            buf, off = binary_column(b.column(2))
            for _, doc, lo, hi, _, _, k1, k2 in _chunk_rows(buf, off):
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), b.column(0).take(take), b.column(1).take(take),
                                                  pa.array(lo.astype(np.int64)), pa.array(hi.astype(np.int64))], ["k1", "k2", "id", "rid", "lo", "hi"])

    return src.mapInArrow(released(run), "k1 long, k2 long, id long, rid long, lo long, hi long")


def _chunk_bytes(docs: DataFrame, text: str, table_) -> DataFrame:
    """(k1, k2, body) of the chunks whose key may be in `table_`."""
    def run(batches):
        for b in batches:
            buf, off = binary_column(b.column(0))
            for part, _, _, _, first, last, k1, k2 in _chunk_rows(buf, off):
                ok = np.flatnonzero(may_hold(table_.value, k1))
                yield pa.RecordBatch.from_arrays([pa.array(k1[ok]), pa.array(k2[ok]), pa.array([part[first[i]:last[i]].tobytes() for i in ok], pa.binary())], ["k1", "k2", "body"])

    return docs.select(text_bytes(text).alias("b")).mapInArrow(released(run), "k1 long, k2 long, body binary")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with repeated chunks cut out of `text`, and `removed_chunks` (runs
    of neighbouring chunks removed), `removed_bytes`. All other columns are unchanged."""
    spark, docs = docs.sparkSession, docs.drop("removed_chunks", "removed_bytes")
    rid = F.xxhash64(F.col(id_col), F.col(text))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("row_id"), rid.alias("row_rid"))
    at = F.struct("id", "rid", "lo")
    occ = stored(find_chunks(docs.withColumn("_rid", rid), id_col, text, "_rid"), "chunks")
    repeated = stored(occ.groupBy("k1", "k2").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first != last").select("k1", "k2", "first"), "repeated-chunks")
    table_ = spark.sparkContext.broadcast(key_filter(repeated, "k1", repeated.count()))
    bodies = _chunk_bytes(docs, text, table_).groupBy("k1", "k2", "body").agg(F.count("*").alias("n"))
    one = bodies.groupBy("k1", "k2").agg(F.count("*").alias("bodies")).where("bodies = 1").select("k1", "k2")
    gone = (occ.join(repeated.join(one, ["k1", "k2"]), ["k1", "k2"]).where(~(at.eqNullSafe(F.col("first"))))
            .groupBy("id", "rid").agg(F.collect_set(F.struct("lo", "hi")).alias("cuts")))  # one document's chunks

    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("removed_chunks", T.IntegerType()), T.StructField("removed_bytes", T.LongType())])
    at_text = docs.columns.index(text)

    def cut(batches):
        for b in batches:
            row, cuts = b.column(0), b.column(1).to_pylist()
            if isinstance(row, pa.ChunkedArray):
                row = row.combine_chunks()
            fields = row.flatten()
            n, size, new = [0] * len(cuts), [0] * len(cuts), {}
            for i, c in enumerate(cuts):
                if c:
                    body, out, pos = fields[at_text][i].as_py().encode(), [], -1
                    for x in sorted(c, key=lambda x: (x["lo"], x["hi"])):
                        if x["lo"] > pos:  # else it overlaps or touches the run before it
                            out.append(body[max(pos, 0):x["lo"]])
                            n[i] += 1
                        size[i] += max(0, x["hi"] - max(x["lo"], pos))
                        pos = max(pos, x["hi"])
                    new[i] = (b"".join(out) + body[pos:]).decode()
            if new:
                fields[at_text] = pa.array([new.get(i, v) if i in new else v for i, v in enumerate(fields[at_text].to_pylist())], fields[at_text].type)
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(fields, fields=list(row.type)), pa.array(n, pa.int32()), pa.array(size, pa.int64())],
                                             ["row", "removed_chunks", "removed_bytes"])

    gone = stored(gone, "cuts")
    return rows.join(gone, F.col("row_id").eqNullSafe(gone["id"]) & (F.col("row_rid") == gone["rid"]), "left").select("row", "cuts").mapInArrow(released(cut), schema).select("row.*", "removed_chunks", "removed_bytes")
