"""Line deduplication by pairwise alignment.

Every line is owned by the earliest document that holds it. A later document is compared
with the owners of all of its lines; the two are aligned line by line (patience diff) and
the aligned common blocks are deleted from the later document.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import P, documents, durable
from tidepool.llm.quality_rules import let

MATRIX = 1 << 26    # cells (bits) of an alignment held at a time
PARTS = 256     # an owner's pairs are dealt over at most so many joins with its lines


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """Bit j of row i is 0 where the longest common subsequence of a[:i + 1] and b[:j + 1]
    is longer than that of a[:i + 1] and b[:j]."""
    full = (1 << len(b)) - 1
    at: dict[int, int] = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    v = full
    for x in a:
        u = v & at.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and b[:j], for j from 0."""
    v = (1 << len(b)) - 1
    for v in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8),
                         bitorder="little")[:len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def subsequence(a: list[int], b: list[int], most: int = MATRIX) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence. Parts of over ``most`` cells are halved
    first (Hirschberg), so memory stays bounded."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        if m - i > 1 and (m - i) * (n - j) > most:
            h = (i + m) // 2
            left = _lengths(a[i:h], b[j:n])
            right = _lengths(a[h:m][::-1], b[j:n][::-1])[::-1]
            cut = j + int(np.argmax(left + right))
            todo += [(i, h, j, cut), (h, m, cut, n)]
            continue
        rows = list(_rows(a[i:m], b[j:n]))
        r, c = m - i, n - j
        while r and c:
            if rows[r - 1] >> (c - 1) & 1:
                c -= 1
            elif r > 1 and not rows[r - 2] >> (c - 1) & 1:
                r -= 1
            else:
                r, c = r - 1, c - 1
                out.append((i + r, j + c))
    return out


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of equal lines: common ends first, then the longest increasing
    chain of lines that are unique in both parts, then the gaps between them; a gap without
    such a line by its longest common subsequence."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i >= m or j >= n:
            continue
        ca, cb = Counter(a[i:m]), Counter(b[j:n])
        place = {x: k for k, x in enumerate(b[j:n], j) if cb[x] == 1}
        pairs = [(k, place[x]) for k, x in enumerate(a[i:m], i) if ca[x] == 1 and x in place]
        if not pairs:
            x = [k for k in range(i, m) if a[k] in cb]
            y = [k for k in range(j, n) if b[k] in ca]
            out += [(x[k], y[h]) for k, h in subsequence([a[k] for k in x], [b[k] for k in y])]
            continue
        tails: list[int] = []
        at: list[int] = []
        back = [-1] * len(pairs)
        for k, (_, y) in enumerate(pairs):
            t = bisect.bisect_left(tails, y)
            tails[t:t + 1], at[t:t + 1] = [y], [k]
            back[k] = at[t - 1] if t else -1
        chain, k = [], at[-1]
        while k >= 0:
            chain.append(pairs[k])
            k = back[k]
        pi, pj = i, j
        for x, y in reversed(chain):
            todo.append((pi, x, pj, y))
            out.append((x, y))
            pi, pj = x + 1, y + 1
        todo.append((pi, m, pj, n))
    return out


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, th, idx, line) of every line with a word; ``line`` is a 64-bit hash."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.when(
        x.rlike(r"[^\x20\x09-\x0D]"), F.struct(i.alias("idx"), F.xxhash64(x).alias("line"))))
    return documents(docs).where("text IS NOT NULL").select(
        "doc_id", "th", F.inline(F.array_compact(lines)))


def shared_lines(lines: DataFrame) -> DataFrame:
    """(doc, idx, line, owner) of the lines that two or more documents hold."""
    spread = lines.groupBy("line").agg(F.min("doc").alias("owner"), F.max("doc").alias("last"))
    return lines.join(spread.where("owner != last").select("line", "owner"), "line")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, th, idx) of the lines to delete: those in a block that aligns with an
    earlier document (order: doc_id, null first, then text hash), and every line of a later
    exact copy. Lines without a word are never compared."""
    found = lines_of(docs).withColumn("doc", F.struct("doc_id", "th"))
    found = durable(found.distinct(), "lines")
    first = found.groupBy("th").agg(F.min("doc").alias("copy_of"))
    found = found.join(first, "th")
    copies = found.where("doc != copy_of").select("doc", "idx")
    lines = found.where("doc = copy_of").select("doc", "idx", "line")
    # lines of one document only align with nothing, so bodies do without them
    lines = durable(shared_lines(lines), "line-spread")
    whole = durable(lines.groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct("idx", "line"))).alias("body")), "line-bodies")
    pairs = lines.where("owner != doc").select("doc", "owner").distinct()
    pairs = durable(pairs.withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(PARTS))), "line-pairs")
    a = whole.select("doc", F.transform("body", lambda x: x["idx"]).alias("idx"),
                     F.transform("body", lambda x: x["line"]).alias("later"))
    b = whole.select(F.col("doc").alias("owner"),
                     F.transform("body", lambda x: x["line"]).alias("earlier"))
    b = b.join(pairs.select("owner", "part").distinct(), "owner")
    met = pairs.join(a, "doc").join(b, ["owner", "part"]).select(
        "doc.doc_id", "doc.th", "idx", "later", "earlier")

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            cut = [[idx[i] for i, _ in patience(list(x), list(y))]
                   for idx, x, y in zip(p["idx"], p["later"], p["earlier"])]
            yield pd.DataFrame({"doc_id": p["doc_id"], "th": p["th"], "cut": cut})

    aligned = met.mapInPandas(align, "doc_id long, th long, cut array<int>").select(
        "doc_id", "th", F.explode("cut").alias("idx"))
    return aligned.unionByName(copies.select("doc.doc_id", "doc.th", "idx")).distinct()


def deduplicated(docs: DataFrame, prefix: str = "") -> DataFrame:
    """All rows and columns of ``docs`` with repeated lines cut out of ``text`` (other lines
    and their order stay), plus ``n_lines`` (with a word), ``n_removed`` and
    ``removed_lines`` (sorted, from 0), their names led by ``prefix``; an input column of
    the same name is replaced.

    A text whose lines all go becomes empty. Null and empty texts stay as they are;
    documents are told apart by (doc_id, text), so repeated rows are one document and all
    of them get the same answer; of exact copies under several ids the smallest id keeps
    its lines; an empty table gives no rows; extra columns are carried along.
    """
    names = [prefix + n for n in ("n_lines", "n_removed", "removed_lines")]
    cut = repeated_lines(docs.select("doc_id", "text")).groupBy(
        F.col("doc_id").alias(P + "id"), F.col("th").alias(P + "th")).agg(
        F.array_sort(F.collect_list("idx")).alias(P + "cut"))
    th = F.xxhash64(F.col("text").cast("string"))
    joined = docs.join(cut, docs["doc_id"].cast("long").eqNullSafe(cut[P + "id"])
                       & (th == cut[P + "th"]), "left").drop(P + "id", P + "th")
    gone = F.coalesce(P + "cut", F.array().cast("array<int>"))
    split = F.split("text", "\n", -1)
    # runs of kept lines between deleted ones, so a long text is copied once
    bounds = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(split)))
    kept = let(F.struct(split.alias("l"), bounds.alias("g")), lambda v: F.flatten(F.transform(
        F.sequence(F.lit(1), F.size(v["g"]) - 1),
        lambda j: F.slice(v["l"], F.get(v["g"], j - 1) + 2,
                          F.get(v["g"], j) - F.get(v["g"], j - 1) - 1))))
    n = F.size(F.filter(split, lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return joined.select(
        *[F.when(F.size(gone) == 0, F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")
          if c == "text" else F.col(c) for c in docs.columns if c not in names],
        F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias(names[0]),
        F.size(gone).cast("long").alias(names[1]), gone.alias(names[2]))
