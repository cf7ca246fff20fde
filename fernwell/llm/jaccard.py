"""Jaccard join of word-shingle sets, size-aware and heavy-light.

Two documents link when the Jaccard similarity of their sets of distinct shingles reaches the
threshold; the result is one row per document with the component of links it lies in.

1. Documents with equal sets form one class, by a digest of the set; one row of it goes on.
2. Shingles are ordered by document frequency, rare ones first, so that what many unrelated
   documents share lies at the end of the order. The frequencies of all shingles are counted in
   buckets (see shared.py), at one entry a block.
3. *Small sets* enumerate the two-element subsets of their prefix, *large sets* put their prefix
   into inverted lists; the boundary is where the subsets become dearer than the entries of the
   lists, whose mean length is measured. Sets just below the boundary do both.
4. Lists are not expanded into pairs. In two rounds each list checks its members against one pivot.
   What links to the pivot leaves the list with it: by the triangle inequality of the Jaccard
   distance its links to the others of the list can only be to those that are near the pivot, and
   these are compared with all of the pivot's component. What is left of lists with members of more
   than one component is compared at last. Both comparisons are made in blocks of bounded size: a
   task holds two blocks, compares what lies in different components, and returns a spanning forest
   of the links it finds, so that rows out are at most rows in. Lists that overlap much are compared
   as one group, where that costs less than one by one.

A shingle that only one document has cannot be shared; what is left of a set bounds its overlap,
and pairs that this bound rules out are never compared. Shingles are 64-bit hashes: two different
ones among n agree with a chance of about n^2 / 2^65; else the result is exact.

Cases: null text or no words: an empty set, linked with nothing; fewer words than a shingle has:
the whole sequence is the one shingle; equal rows share a class; rows without an id, or with one id
and several texts, take part row by row; a very long text is one set in one block; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import (
    block_count,
    column_bytes,
    components,
    cut_by_bucket,
    discard,
    sorted_distinct,
    documents_of,
    in_blocks,
    lower_ascii,
    mix,
    planes,
    ranges,
    runs,
    stash,
    text_bytes,
    unplanes,
    with_text_hash,
    word_bounds,
    word_hashes,
)

#: One shingle of so many is taken for the measured length of lists.
_LIST_SAMPLE = 1024
_K = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(off: np.ndarray, data: np.ndarray, words: int, slice_bytes: int = 1 << 20) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of each document; works on slices of bounded size, or on
    one document where it is longer."""
    out: list[np.ndarray] = []
    at, n = 0, len(off) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + slice_bytes, "right")) - 1)
        out += _sets_of_slice(off[at : to + 1] - off[at], data[off[at] : off[to]], words)
        at = to
    return out


def _sets_of_slice(off: np.ndarray, data: np.ndarray, words: int) -> list[np.ndarray]:
    n_docs = len(off) - 1
    data = lower_ascii(data)
    s, e, first = word_bounds(data, off)
    h = word_hashes(data, s, e)
    counts, first = np.diff(first), first[:-1]
    if len(h) >= words:
        roll = np.zeros(len(h) - words + 1, np.uint64)
        for i in range(words):
            roll = roll * _K + h[i : len(h) - words + 1 + i]
        roll = mix(roll)
    else:
        roll = np.zeros(0, np.uint64)
    out = []
    for f, c in zip(first.tolist(), counts.tolist(), strict=True):
        if c >= words:
            out.append(sorted_distinct(roll[f : f + c - words + 1]))
        elif c:
            x = np.array([c], np.uint64)
            for v in h[f : f + c]:
                x = mix(x * _K + v)
            out.append(x)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that tell sets apart."""
    if not len(s):
        return 0, 0
    a = int(mix(s).sum()) & (2**64 - 1)
    b = int(mix(s ^ _K).sum()) & (2**64 - 1)
    return a - (1 << 63), b - (1 << 63)


def least_overlap(n: int | np.ndarray, percent: int):  # noqa: ANN201
    """Shingles that a set of n shares at least with any set it links to."""
    return -(-percent * n // 100)


def list_length(steps: list[tuple[float, float, float]], percent: int) -> float:
    """Mean length of the lists that prefixes meet: prefixes have the rarest 100 - percent of a set's
    shingles, and those that one set alone has are in no list. steps: power of two of the document
    frequency, sum and sum of squares of it."""
    steps = [s for s in steps if s[0] > 0]
    room = (1 - percent / 100) * sum(a for _, a, _ in steps)
    taken = total = 0.0
    for _, a, b in sorted(steps):
        share = min(1.0, max(0.0, room - taken) / a)
        taken, total = taken + share * a, total + share * b
    return total / taken if taken else 1.0


def boundary(sizes: list[tuple[int, int]], list_length: float, percent: int) -> int:
    """The size from which inverted lists cost less than two-element subsets, over the measured
    sizes (size, count)."""
    best, cost, sizes = 2, 0.0, sorted(sizes)
    least = 0.0
    for n, count in sizes:
        p1 = n - least_overlap(n, percent) + 1
        p2 = p1 + 1
        cost += count * (p2 * (p2 - 1) / 2 - p1 * max(1.0, list_length))
        if cost < least:
            least, best = cost, n + 1
    return best


#: Ids of rows without one sort behind all others.
_NO_ID = (1 << 63) - 1


def link_components(docs: DataFrame, **how) -> DataFrame:  # noqa: ANN003
    """doc_id, n_shingles, component_id of every document; options as of linked_rows()."""
    return linked_rows(docs, **how).select("doc_id", "n_shingles", "component_id")


def linked_rows(docs: DataFrame, words: int = 5, percent: int = 80, block_bytes: int = 2 << 20, bucket_bytes: int = 4 << 20, block_tokens: int = 1 << 17, pivot_rounds: int = 2) -> DataFrame:
    """doc_id, th (xxhash64 of the text), n_shingles, component_id of every document, and first:
    whether the row has the smallest (doc_id, th) of its component, as all equal rows then have.
    Links at 100 * common >= percent * all."""
    total = text_bytes(docs)
    docs = with_text_hash(documents_of(docs))

    def describe(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                sets = shingle_sets(*column_bytes(b["text"]), words)
                dg = [digest(s) for s in sets]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": b["doc_id"],
                        "th": b["th"],
                        "n": pa.array([len(s) for s in sets], pa.int64()),
                        "d1": pa.array([x[0] for x in dg], pa.int64()),
                        "d2": pa.array([x[1] for x in dg], pa.int64()),
                        "some": pa.array([s[s % np.uint64(_LIST_SAMPLE) == 0].view(np.int64) for s in sets], pa.list_(pa.int64())),
                    }
                )

    seen = stash(docs.mapInArrow(describe, "doc_id long, th long, n long, d1 long, d2 long, some array<long>"), "sets")
    row_key = F.struct(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"), "th")
    # written, so that the join below deals its rows by itself and a hot class can be split there
    classes = stash(seen.where("n > 0").groupBy("d1", "d2", "n").agg(F.min(row_key).alias("rep")), "reps")
    reps = classes.select(F.nullif("rep.doc_id", F.lit(_NO_ID)).alias("doc_id"), "rep.th", "d1", "n")
    # sizes fall into steps of an eighth, so that what is gathered does not grow with the table
    step = F.floor(F.log2("n") * 8)
    sizes = [(int(r["m"]), int(r["c"])) for r in reps.where("n > 1").groupBy(step.alias("k")).agg(F.max("n").alias("m"), F.count("*").alias("c")).collect()]
    lengths = seen.select(F.explode("some").alias("s")).groupBy("s").agg(F.count("*").cast("double").alias("c"))
    # at most one row for each power of two
    steps = lengths.groupBy(F.ceil(F.log2("c")).alias("k")).agg(F.sum("c").alias("a"), F.sum(F.col("c") * F.col("c")).alias("b")).collect()
    cut = boundary(sizes, list_length([(r["k"], r["a"], r["b"]) for r in steps], percent), percent)

    lists = _signatures(docs, reps, total, words, percent, cut, block_bytes, bucket_bytes)
    linked = _resolve(lists, percent, pivot_rounds, block_tokens)
    discard(lists)
    # the first row of each component, for the classes that have links
    tied = classes.join(linked.withColumnRenamed("node", "d1"), "d1")
    first = stash(tied.join(tied.groupBy("component").agg(F.min("rep").alias("first")), "component").select("d1", "d2", "n", "first"), "first")
    discard(linked)
    known = classes.join(first, ["d1", "d2", "n"], "left").select("d1", "d2", "n", F.coalesce("first", "rep").alias("first"))
    out = seen.select("doc_id", "th", "n", "d1", "d2").join(known, ["d1", "d2", "n"], "left")
    lead = F.coalesce("first", row_key)
    return out.select(
        "doc_id", "th", F.col("n").alias("n_shingles"), F.nullif(lead["doc_id"], F.lit(_NO_ID)).alias("component_id"),
        (lead == row_key).alias("first"),
    )


def one_of_each(docs: DataFrame, **how) -> DataFrame:  # noqa: ANN003
    """The row of each component with the smallest doc_id (then hash of the text), with all its
    columns; of rows equal in both, one."""
    kept = linked_rows(docs, **how).where("first").groupBy("doc_id", "th").agg(F.count("*").alias("m"))
    kept = stash(kept.select(F.struct("doc_id", "th").alias("key"), (F.col("m") > 1).alias("many")), "kept")
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("th"))
    rows = docs.select(key.alias("key"), F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))
    if kept.where("many").isEmpty():
        return rows.join(kept, "key", "left_semi").select("row.*")
    # equal rows are told apart by nothing: any one of them
    once = rows.join(kept.where("NOT many"), "key", "left_semi")
    more = rows.join(kept.where("many"), "key", "left_semi").groupBy("key").agg(F.first("row").alias("row"))
    return once.unionByName(more).select("row.*")


def _signatures(docs, reps, total, words, percent, cut, block_bytes, bucket_bytes) -> DataFrame:  # noqa: ANN001
    """(sig, v, n, u, body): list entries of the classes v with n shingles, u of which others may
    share, and one row with sig null and the set for each class that is in a list."""
    n_blocks = block_count(total, block_bytes)
    d = in_blocks(docs, n_blocks)
    n_buckets = block_count(total * 4 // 6, bucket_bytes)  # four bytes a word of about six

    def distinct_sets(t: pa.Table) -> tuple[list[tuple], list[np.ndarray], list[int]]:
        t = t.sort_by([("doc_id", "ascending"), ("th", "ascending")])
        sets = shingle_sets(*column_bytes(t["text"]), words)
        rows, dg = list(zip(t["doc_id"].to_pylist(), t["th"].to_pylist(), strict=True)), [digest(s) for s in sets]
        new = {x: i for i, x in reversed(list(enumerate(dg)))}
        keep = [i for i in sorted(new.values()) if len(sets[i])]
        return [rows[i] for i in keep], [sets[i] for i in keep], [dg[i][0] for i in keep]

    def keys_of(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        both = np.sort(np.concatenate([s >> np.uint64(32) for s in sets] or [np.zeros(0, np.uint64)]))
        first = runs(both)
        return both[first], np.diff(np.append(first, len(both)))

    def ask(t: pa.Table) -> pa.Table:
        block = t["block"][0].as_py()
        keys, counts = keys_of(distinct_sets(t)[1])
        cuts = cut_by_bucket(keys << np.uint64(32), n_buckets)
        some = np.flatnonzero(np.diff(cuts))
        small = np.minimum(counts, 255).astype(np.uint8)
        return pa.table(
            {
                "block": pa.array(np.full(len(some), block, np.int32)),
                "bucket": pa.array(some.astype(np.int32)),
                "payload": pa.array([planes(keys[cuts[b] : cuts[b + 1]].astype(np.uint32)) + small[cuts[b] : cuts[b + 1]].tobytes() for b in some], pa.binary()),
            }
        )

    def count(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        arrays, counts = [], []
        for x in t["payload"].to_pylist():
            m = len(x) // 5
            arrays.append(unplanes(x[: 4 * m], np.uint32))
            counts.append(np.frombuffer(x, np.uint8, m, 4 * m))
        both = np.concatenate(arrays)
        order = np.argsort(both, kind="stable")
        first = runs(both[order])
        df = np.add.reduceat(np.concatenate(counts).astype(np.int64)[order], first)
        level = np.ceil(np.log2(df)).astype(np.uint8)
        code = np.empty(len(both), np.uint8)
        code[order] = np.repeat(level, np.diff(np.append(first, len(both))))
        return pa.table(
            {
                "block": t["block"].cast(pa.int32()), "bucket": t["bucket"].cast(pa.int32()),
                "payload": pa.array([c.tobytes() for c in np.split(code, np.cumsum([len(a) for a in arrays])[:-1])], pa.binary()),
            }
        )

    def emit(t: pa.Table, a: pa.Table) -> pa.Table:
        sigs, vs, ns, us, bodies = [], [], [], [], []
        if t.num_rows:
            rows, sets, d1 = distinct_sets(t)
            lead = {(i, h, x) for i, h, x in zip(a["doc_id"].to_pylist(), a["th"].to_pylist(), a["d1"].to_pylist(), strict=True) if x is not None}
            answers = sorted((b, p) for b, p in zip(a["bucket"].to_pylist(), a["payload"].to_pylist(), strict=True) if p is not None)
            keys, _ = keys_of(sets)
            levels = np.frombuffer(b"".join(p for _, p in answers), np.uint8)
            for row, s, x in zip(rows, sets, d1, strict=True):
                if (*row, x) not in lead or len(s) < 2:
                    continue
                n = len(s)
                level = levels[np.searchsorted(keys, s >> np.uint64(32))]
                p1 = n - int(least_overlap(n, percent)) + 1
                order = np.lexsort((s, level))[: p1 + 1]
                own = []
                if n < cut:
                    r = s[order][level[order] > 0]
                    if len(r) > 1:
                        u, v = np.triu_indices(len(r), 1)
                        own.append(mix(r[u] * _K + r[v]))
                if 100 * n >= percent * cut:
                    order = order[:p1]
                    own.append(s[order][level[order] > 0])
                own = np.concatenate(own) if own else np.zeros(0, np.uint64)
                if len(own):
                    m = len(own) + 1
                    sigs.append(pa.array(np.append(own.view(np.int64), 0), mask=np.arange(m) == m - 1))
                    vs.append(np.full(m, x, np.int64))
                    ns.append(np.full(m, n, np.int64))
                    us.append(np.full(m, np.count_nonzero(level), np.int64))
                    bodies += [None] * (m - 1) + [s.tobytes()]
        whole = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.table(
            {
                "sig": pa.concat_arrays(sigs) if sigs else pa.array([], pa.int64()),
                "v": whole(vs), "n": whole(ns), "u": whole(us), "body": pa.array(bodies, pa.binary()),
            }
        )

    by_block = d.groupBy("block")
    asked = by_block.applyInArrow(ask, "block int, bucket int, payload binary")
    answered = asked.groupBy("bucket").applyInArrow(count, "block int, bucket int, payload binary")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    right = answered.select("block", "bucket", "payload", none("long", "doc_id"), none("long", "th"), none("long", "d1")).unionByName(
        in_blocks(reps, n_blocks).select("block", none("int", "bucket"), none("binary", "payload"), "doc_id", "th", "d1")
    )
    return stash(
        by_block.cogroup(right.groupBy("block")).applyInArrow(emit, "sig long, v long, n long, u long, body binary"), "lists"
    )


def _common(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        n = []
        for x, y in zip(b["body_a"], b["body_b"], strict=True):
            p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            if len(p) > len(q):
                p, q = q, p
            at = np.searchsorted(q, p)
            at[at == len(q)] = 0
            n.append(int(np.count_nonzero(q[at] == p)))
        yield pa.RecordBatch.from_pydict({"a": b["a"], "b": b["b"], "na": b["na"], "nb": b["nb"], "common": pa.array(n, pa.int64())})


def _resolve(lists: DataFrame, percent: int, pivot_rounds: int, block_tokens: int) -> DataFrame:
    """(node, component) of the links between the classes of the lists."""
    bodies = lists.where("sig IS NULL").select("v", "n", "u", "body")
    slim = bodies.select("v", "n", "u")
    entries = lists.where("sig IS NOT NULL").select("sig", "v", "n", "u", F.col("v").alias("c"))
    # overlaps are at most what both sets can share
    most = F.least("ua", "ub")
    fits = f"100 * least(ua, ub) >= {percent} * (na + nb - least(ua, ub))"
    link = f"100 * common >= {percent} * (na + nb - common)"
    near_limit = max(0, 2 * percent - 100)
    comp: DataFrame | None = None
    open_: DataFrame | None = None
    for k in range(pivot_rounds):
        # open lists: their members are in more than one component. The pivot is of the component
        # that most of them are in, and of these the one with the fewest shingles of its own
        best = F.struct((F.col("u") - F.col("n")).alias("d"), "v", "n", "u", "c")
        if k:
            per = entries.groupBy("sig", "c").agg(F.count("*").alias("m"), F.max(best).alias("p"))
            heads = per.groupBy("sig").agg(F.max(F.struct("m", "p")).alias("q"), F.min("c").alias("x"), F.max("c").alias("y")).withColumn("p", F.col("q.p"))
        else:
            heads = entries.groupBy("sig").agg(F.max(best).alias("p"), F.min("c").alias("x"), F.max("c").alias("y"))
        heads = heads.where("x < y").select("sig", F.col("p.v").alias("a"), F.col("p.n").alias("na"), F.col("p.u").alias("ua"))
        member = entries.select("sig", F.col("v").alias("b"), F.col("n").alias("nb"), F.col("u").alias("ub")).join(heads, "sig").where("a <> b")
        pairs = member.where(fits).select("a", "b", "na", "nb").distinct()
        left = bodies.select(F.col("v").alias("a"), F.col("body").alias("body_a"))
        right = bodies.select(F.col("v").alias("b"), F.col("body").alias("body_b"))
        done = stash(pairs.join(left, "a").join(right, "b").mapInArrow(_common, "a long, b long, na long, nb long, common long"), "pairs")
        before, comp = comp, components(_with(done.where(link).select("a", "b"), comp), "classes")
        # members with what is known of their distance to the pivot
        at = member.join(done.select("a", "b", "common"), ["a", "b"], "left").withColumn("linked", F.coalesce(F.expr(link), F.lit(False)))
        top = F.coalesce("common", most)
        at = stash(at.where("NOT linked").select("sig", "a", "b", F.col("nb").alias("n"), F.col("ub").alias("u"), (100 * top >= near_limit * (F.col("na") + F.col("nb") - top)).alias("near")), "left")
        discard(done, *(x for x in (before, open_) if x is not None))
        extra = _near_links(at, comp, slim, bodies, percent, block_tokens)
        if extra is not None:
            before, comp = comp, components(_with(extra, comp), "classes")
            discard(extra, before)
        rest = at.select("sig", F.col("b").alias("v"), "n", "u").join(comp.withColumnRenamed("node", "v"), "v", "left")
        rest = rest.select("sig", "v", "n", "u", F.coalesce("component", "v").alias("c"))
        still = rest.groupBy("sig").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y").select("sig")
        entries = open_ = stash(rest.join(still, "sig"), "open")
        discard(at)
        if entries.isEmpty():
            return comp
    extra = _list_links(entries, bodies, percent, block_tokens)
    out = components(_with(extra, comp), "classes")
    discard(extra, comp, entries)
    return out


def _with(found: DataFrame, comp: DataFrame | None) -> DataFrame:
    """New links and, in place of the earlier ones, an edge from each node to its component."""
    return found if comp is None else found.unionByName(comp.select(F.col("node").alias("a"), F.col("component").alias("b")))


def _near_links(at: DataFrame, comp: DataFrame, slim: DataFrame, bodies: DataFrame, percent: int, block_tokens: int) -> DataFrame | None:
    """Links of what is near a pivot (a; b near it) to the members of the pivot's component."""
    where = comp.select(F.col("node").alias("v"), F.col("component").alias("c"))
    near = (
        at.where("near").select(F.col("a"), F.col("b").alias("v"), "n", "u").distinct()
        .join(where.select(F.col("v").alias("a"), F.col("c").alias("g")), "a")
        .join(where, "v", "left").select("g", "v", "n", "u", F.coalesce("c", "v").alias("c")).where("c <> g").distinct()
    )
    near = stash(near, "near")
    if near.isEmpty():
        discard(near)
        return None
    own = where.join(near.select(F.col("g").alias("c")).distinct(), "c", "left_semi").join(slim, "v")
    members = near.unionByName(own.select(F.col("c").alias("g"), "v", "n", "u", "c"))
    found = _block_links(members, bodies, percent, block_tokens)
    discard(near)
    return found


def _list_links(e: DataFrame, bodies: DataFrame, percent: int, block_tokens: int) -> DataFrame:
    """Links between members of one list and different components."""
    # groups of lists that share members: one comparison of the group, or one for each list
    low = e.groupBy("sig").agg(F.min("v").alias("w"))
    edges = e.join(low, "sig").select(F.col("v").alias("a"), F.col("w").alias("b"))
    group = components(edges, "groups").withColumnRenamed("node", "v").withColumnRenamed("component", "k")
    named = stash(e.join(group, "v").select("sig", "v", "n", "u", "c", "k"), "named")
    by_list = named.groupBy("sig", "k").agg(F.count("*").cast("double").alias("m")).groupBy("k").agg(F.sum(F.col("m") * F.col("m")).alias("one_by_one"))
    by_group = named.select("k", "v").distinct().groupBy("k").agg(F.count("*").cast("double").alias("m"))
    # one row a group; repeated under salts, as a group may have a third of the rows
    whole = by_group.join(by_list, "k").select("k", (F.col("m") * F.col("m") <= F.col("one_by_one")).alias("whole"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    salted = named.withColumn("salt", F.pmod(F.xxhash64("v", "sig"), F.lit(_SALTS)).cast("int")).join(whole, ["k", "salt"])
    members = salted.select(F.when(F.col("whole"), F.xxhash64("k", F.lit(1))).otherwise(F.xxhash64("sig", F.lit(2))).alias("g"), "v", "n", "u", "c").distinct()
    found = _block_links(members, bodies, percent, block_tokens)
    discard(named, group)
    return found


_SALTS = 32


def _block_links(member: DataFrame, bodies: DataFrame, percent: int, block_tokens: int) -> DataFrame:
    """A spanning forest (a, b) of the links between members (g, v, n, u, c) of one group g and
    different components c."""
    # blocks: large components have their own, small ones share
    member = stash(member, "members")
    size = member.groupBy("g", "c").agg(F.sum("n").alias("t"))
    size = size.withColumn("big", F.col("t") >= block_tokens // 2)
    rest = size.where("NOT big").groupBy("g").agg(F.ceil(F.sum("t") / block_tokens).cast("int").alias("parts"))
    size = size.join(rest, "g", "left").select(
        "g", "c", "big", F.when(F.col("big"), F.ceil(F.col("t") / block_tokens).cast("int")).otherwise(F.col("parts")).alias("parts")
    )
    dealt = member.join(size, ["g", "c"]).select(
        "g", "v", "n", "u", "c",
        F.when(F.col("big"), F.col("c")).alias("own"), F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("i"),
    ).withColumn("block", F.xxhash64("own", "i"))
    dealt = stash(dealt, "dealt")
    blocks = dealt.select("g", "block", "own").distinct()
    x = blocks.select("g", F.col("block").alias("x"), F.col("own").alias("ox"))
    y = blocks.select("g", F.col("block").alias("y"), F.col("own").alias("oy"))
    # two blocks of one large component have nothing to compare
    couples = x.join(y, "g").where("x <= y AND NOT coalesce(ox = oy, false)").select("g", "x", "y")
    task = F.xxhash64("g", "x", "y").alias("task")
    left = dealt.join(couples.withColumn("block", F.col("x")), ["g", "block"])
    right = dealt.join(couples.where("x <> y").withColumn("block", F.col("y")), ["g", "block"])
    sides = left.select(task, F.lit(0).alias("side"), "v", "n", "u", "c").unionByName(right.select(task, F.lit(1).alias("side"), "v", "n", "u", "c"))

    def run(t: pa.Table) -> pa.Table:
        side = t["side"].to_numpy()
        ids, n, u, c = (t[x].to_numpy() for x in ("v", "n", "u", "c"))
        sets = [np.frombuffer(x, np.uint64) for x in t["body"].to_pylist()]
        a = np.flatnonzero(side == 0)
        b = np.flatnonzero(side == 1)
        b = b if len(b) else a
        if not len(a):
            a = b
        token = np.concatenate([sets[i] for i in a])
        owner = np.repeat(np.arange(len(a)), n[a])
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        first = runs(token)
        unlike, last = token[first], np.append(first, len(token))
        names, label = np.unique(c, return_inverse=True)  # components, joined as links are found
        out_a, out_b = [], []
        for k in b.tolist():
            most = np.minimum(u[a], u[k])
            able = (label[a] != label[k]) & (100 * most >= percent * (n[a] + n[k] - most))
            if not able.any():
                continue
            at = np.searchsorted(unlike, sets[k])
            at[at == len(unlike)] = 0
            at = at[unlike[at] == sets[k]]
            common = np.bincount(owner[ranges(last[at], last[at + 1] - last[at])], minlength=len(a))
            hit = np.flatnonzero(able & (100 * common >= percent * (n[a] + n[k] - common)))
            joined, where = np.unique(label[a[hit]], return_index=True)
            for r, w in zip(joined.tolist(), hit[where].tolist(), strict=True):
                out_a.append(int(ids[a[w]]))
                out_b.append(int(ids[k]))
                label[label == r] = label[k]
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    found = stash(sides.join(bodies.select("v", "body"), "v").groupBy("task").applyInArrow(run, "a long, b long"), "block_links")
    discard(member, dealt)
    return found
