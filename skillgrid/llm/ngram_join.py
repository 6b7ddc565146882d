"""N-gram Jaccard join: near-duplicate documents by chosen-path recursion.

Documents are sets of five-word shingles; two are linked if their Jaccard
similarity is at least 0.8.

Method (chosen path): a document's minimum under a shared random order of all
shingles is a token sampled from its set, and two sets of similarity J sample
the same one with probability J. A run sends every set down the branch named by
its sampled token; a branch that is still large is split again on several
further sampled tokens, and small buckets are brute-forced. A bucket whose
members stay together under a further split is a family of near copies; it is
brute-forced in blocks instead of being split for ever. Runs repeat until a
pair at the threshold is missed with probability below ``1 - RECALL``.

1. One pass over whole texts gives per document a fingerprint of its shingle
   set and ``COORDINATES`` sampled tokens. Equal sets collapse to one
   representative with its number of copies (map-side combined).
2. The recursion works on (representative, branch) rows; brute force compares
   the sampled tokens and passes pairs that agree on at least half of them
   (a pair at the threshold agrees on 0.8 of them, 5 deviations above).
   Buckets emit a spanning set of edges, never all their pairs.
3. Connected candidates are verified: their texts are read again and exact
   intersections of the full shingle sets are counted by block matrix products
   over the shingles that at least two of them hold. Components larger than a
   block are compared block against block, each pair of blocks in its own task.
4. Verified links give every representative its number of links and, by
   connected components, its class. Copies count through their multiplicity.

Scale: whole texts shuffle once, for step 3, and only candidates stay. All hot
groups are collapsed (equal sets), split (branches) or blocked (families); the
number of links of a family is exact, so its cost is quadratic in the number of
*different* texts in it, spread over many tasks.

Defined results: words are maximal runs of bytes other than space and
0x09-0x0D, compared exactly; a text of one to four words is one shingle; null
texts and texts without words have no shingles and are linked to nothing, not
even each other; rows with equal ids or repeated rows are documents of their
own; a class without any id has a null class id; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillgrid.llm.common import components, grouped, materialize, row_key, tasks, text_or_empty
from skillgrid.llm.text_hash import mix, shingles, word_hashes

WIDTH = 5
SIMILARITY = (4, 5)  # at least 4/5, compared in integers
COORDINATES = 64
RECALL = 0.999999
LEAF = 256  # branches up to this many sets are brute-forced at once
FANOUT = 3  # further tokens sampled when a branch is split
DEPTH = 4
BLOCK = 1024  # sets per side when sampled tokens are compared block by block
VERIFY_BLOCK = 192  # documents per side of a verification
VERIFY_SHINGLES = 400_000  # and shingles per side, for long texts
_ODD = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_MUL, _ADD = (_ODD[:COORDINATES] | np.uint64(1)).astype(np.uint32), (_ODD[COORDINATES:] >> np.uint64(32)).astype(np.uint32)


def runs_for(recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold is missed with probability below 1 - recall."""
    return min(COORDINATES, math.ceil(math.log(1 - recall) / math.log(1 - SIMILARITY[0] / SIMILARITY[1])))


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        texts = [t.encode("utf-8", "surrogatepass") for t in b["text"]]
        for a, z in _slices([len(t) for t in texts], 1 << 20):
            hashes, offsets = shingles(*word_hashes(texts[a:z]), WIDTH)
            n = z - a
            sizes, rep, sig = np.zeros(n, np.int64), [None] * n, [None] * n
            some = np.flatnonzero(np.diff(offsets))
            if len(some):
                low = (hashes >> np.uint64(32)).astype(np.uint32)
                tokens = np.empty((len(some), COORDINATES), np.uint32)
                for j in range(COORDINATES):
                    tokens[:, j] = np.minimum.reduceat(low * _MUL[j] + _ADD[j], offsets[some])
                for k, i in enumerate(some):
                    own = np.unique(hashes[offsets[i] : offsets[i + 1]])
                    sizes[i] = len(own)
                    halves = np.array([mix(own).sum(), np.bitwise_xor.reduce(mix(own ^ np.uint64(0x5851F42D4C957F2D)))])
                    rep[i] = halves.astype(np.uint64).tobytes()
                    sig[i] = tokens[k].tobytes()
            part = b.iloc[a:z]
            yield pd.DataFrame({"doc_id": part["doc_id"], "key": part["key"], "rep": rep, "n_set": sizes, "sig": sig})


def _slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges whose summed sizes stay under ``most`` (or hold one item)."""
    a = total = 0
    for i, size in enumerate(sizes):
        if total + size > most and i > a:
            yield a, i
            a, total = i, 0
        total += size
    if a < len(sizes):
        yield a, len(sizes)


def _row_name() -> F.Column:
    """Both 64-bit hashes of id and text, as 16 bytes: rows equal in both share it."""
    halves = [F.lpad(F.hex(h), 16, "0") for h in row_key(F.col("doc_id"), F.col("text"))]
    return F.unhex(F.concat(*halves))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, key, rep, n_set, sig) per row; rep and sig are null without words."""
    rows = docs.select("doc_id", text_or_empty(F.col("text")).alias("text"), _row_name().alias("key"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key binary, rep binary, n_set long, sig binary"
    return materialize(rows.mapInPandas(_signatures, schema), "ngram-signatures")


def _token(i) -> F.Column:
    return F.expr(f"substring(sig, {i} * 4 + 1, 4)")


def buckets(reps: DataFrame, recall: float = RECALL) -> DataFrame:
    """(rep, node, n): the leaves of the recursion that at least two sets share."""
    runs = F.array(*(F.xxhash64(F.lit(r), _token(r)) for r in range(runs_for(recall))))
    front = reps.select("rep", F.explode(runs).alias("node"))
    leaves = None
    for depth in range(DEPTH + 1):
        shared = front.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        front = materialize(front.join(shared, "node").select("rep", "node", "n"), "ngram-branches")
        done = front if depth == DEPTH else front.where(F.col("n") <= LEAF)
        leaves = done if leaves is None else leaves.union(done)
        large = front.where(F.col("n") > LEAF)
        if depth == DEPTH or not large.limit(1).count():
            return leaves
        # The coordinates of the split are drawn from the branch, so its members agree on them.
        picks = F.transform(F.sequence(F.lit(1), F.lit(FANOUT)), lambda c: F.pmod(F.xxhash64("node", c), F.lit(COORDINATES)).cast("int"))
        child = F.expr("transform(picks, i -> xxhash64(node, i, substring(sig, i * 4 + 1, 4)))")
        split = large.join(reps.select("rep", "sig"), "rep").withColumn("picks", F.array_distinct(picks))
        split = materialize(split.select("rep", F.col("node").alias("parent"), "n", F.explode(child).alias("node")), "ngram-split")
        sizes = split.groupBy("parent", "node").agg(F.count("*").alias("m"), F.max("n").alias("n"))
        family = sizes.groupBy("parent").agg((F.max("m") * 2 > F.max("n")).alias("family"))
        leaves = leaves.union(large.join(family.where("family"), F.col("node") == F.col("parent"), "left_semi"))
        front = split.join(family.where("not family"), "parent").select("rep", "node")
    return leaves


def _blocked(rows: DataFrame, group: str, n_blocks) -> DataFrame:
    """Each row to the block pairs (bi <= bj) of its group that hold its block."""
    blocks = rows.withColumn("nb", n_blocks.cast("int")).withColumn("blk", F.pmod(F.xxhash64("rep", group), F.col("nb")).cast("int"))
    other = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    return other.withColumns({"bi": F.least("blk", "other"), "bj": F.greatest("blk", "other")}).drop("other")


def _least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each row's component under the pairs (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _link_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def work(frame: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(frame["sig"]), np.uint32).reshape(len(frame), COORDINATES)
        blk = frame["blk"].to_numpy()
        # Block pairs (bi < bj) compare across the blocks only.
        across = (frame["bi"] != frame["bj"]).to_numpy()
        ends = np.searchsorted(group, group, side="right")
        a_all, b_all = [], []
        gap = 1
        at = np.flatnonzero(ends > np.arange(len(frame)) + 1)
        while len(at):
            for part in np.array_split(at, max(1, len(at) // 16384)):
                other = part + gap
                use = ~across[part] | (blk[part] != blk[other])
                i, j = part[use], other[use]
                near = (sig[i] == sig[j]).sum(1) * 2 >= COORDINATES
                a_all.append(i[near])
                b_all.append(j[near])
            gap += 1
            at = at[ends[at] > at + gap]
        if not a_all:
            return pd.DataFrame({"a": [], "b": []})
        label = _least_labels(len(frame), np.concatenate(a_all), np.concatenate(b_all))
        moved = np.flatnonzero(label != np.arange(len(frame)))
        rep = frame["rep"].to_numpy()
        return pd.DataFrame({"a": rep[label[moved]], "b": rep[moved]})

    for b in grouped(batches, ["node", "bi", "bj"], work, 4096):
        yield b


def candidate_edges(reps: DataFrame, recall: float = RECALL) -> DataFrame:
    """Spanning edges (a, b) of the candidate pairs that the buckets' brute force passes."""
    spark = reps.sparkSession
    rows = _blocked(buckets(reps, recall), "node", F.ceil(F.col("n") / BLOCK)).join(reps.select("rep", "sig"), "rep")
    # Sorted by set too: spanning edges then lead to a bucket's least set, which the runs mostly agree on.
    dealt = rows.repartition(tasks(spark), "node", "bi", "bj").sortWithinPartitions("node", "bi", "bj", "rep")
    edges = dealt.select("node", "bi", "bj", "blk", "rep", "sig").mapInPandas(_link_buckets, "a binary, b binary")
    return materialize(edges.distinct(), "ngram-candidates")


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of the left sets with the right ones."""
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, which, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times > 1
    number = np.cumsum(common) - 1
    held = common[which]
    doc, column = doc[held], number[which[held]]
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    out = np.zeros((len(left), len(right)), np.float64)
    width = max(1, (1 << 21) // len(sets))
    for start in range(0, int(common.sum()), width):
        a, z = np.searchsorted(column, [start, start + width])
        dense = np.zeros((len(sets), width), np.float32)
        dense[doc[a:z], column[a:z] - start] = 1
        out += dense[left] @ dense[right].T
    return out


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per group: its verified spanning edges (a, b, blocks) and link counts (a, null, links)."""

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("rep")
        hashes, offsets = shingles(*word_hashes([t.encode("utf-8", "surrogatepass") for t in frame["text"]]), WIDTH)
        sets = [np.unique(hashes[a:z]) for a, z in zip(offsets[:-1], offsets[1:], strict=True)]
        rep, copies, blk = frame["rep"].to_numpy(), frame["copies"].to_numpy(), frame["blk"].to_numpy()
        bi, bj = frame["bi"].iloc[0], frame["bj"].iloc[0]
        left, right = np.flatnonzero(blk == bi), np.flatnonzero(blk == bj)
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "links": []})
        size = np.array([len(s) for s in sets])
        both = _intersections(sets, left, right)
        joint = size[left][:, None] + size[right][None, :] - both
        linked = both * SIMILARITY[1] >= joint * SIMILARITY[0]
        links = np.zeros(len(frame))
        if bi == bj:
            np.fill_diagonal(linked, False)
            links[left] = linked @ copies[right]
        else:
            links[left] = linked @ copies[right]
            links[right] = linked.T @ copies[left]
        x, y = np.nonzero(linked)
        label = _least_labels(len(frame), left[x], right[y])
        moved = np.flatnonzero(label != np.arange(len(frame)))
        counted = np.flatnonzero(links)
        return pd.DataFrame({
            "a": np.concatenate((rep[label[moved]], rep[counted])),
            "b": np.concatenate((rep[moved], np.full(len(counted), None, object))),
            "links": np.concatenate((np.full(len(moved), frame["nb"].iloc[0]), links[counted])).astype(np.int64),
        })

    def work(frame: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        parts = [one(g) for _, g in frame.groupby(group, sort=False)]
        return pd.concat(parts, ignore_index=True)

    yield from grouped(batches, ["comp", "bi", "bj"], work, 256)


def verified(docs: DataFrame, reps: DataFrame, edges: DataFrame) -> DataFrame:
    """(a, b, links): exact spanning edges (b set, links: blocks of the component) and link counts (b null).

    An edge leads from its group's least set to another; the edges of a component of one block are a star.
    """
    spark = docs.sparkSession
    label = components(edges, "a", "b", "ngram-comp").select(F.col("node").alias("rep"), F.col("label").alias("comp"))
    members = label.join(reps.select("rep", "doc_key", "copies", "n_set"), "rep")
    weight = members.groupBy("comp").agg(F.count("*").alias("n"), F.sum("n_set").alias("total"))
    n_blocks = F.greatest(F.ceil(F.col("n") / VERIFY_BLOCK), F.ceil(F.col("total") / VERIFY_SHINGLES))
    members = members.join(weight, "comp").withColumn("nb", F.least(n_blocks, F.col("n")))
    members = materialize(members.select("rep", "comp", "copies", F.col("doc_key").alias("key"), "nb"), "ngram-members")
    texts = docs.select(text_or_empty(F.col("text")).alias("text"), _row_name().alias("key"))
    # One plan at every size: the members are not broadcast while they are few.
    rows = _blocked(texts.join(members.hint("merge"), "key"), "comp", F.col("nb"))
    dealt = rows.select("comp", "bi", "bj", "blk", "nb", "rep", "copies", "text").repartition(tasks(spark), "comp", "bi", "bj")
    found = dealt.sortWithinPartitions("comp", "bi", "bj", "rep").mapInPandas(_verify, "a binary, b binary, links long")
    return materialize(found, "ngram-links")


def near_duplicates(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """(doc_id, key, rep, class, keeper, class_rows, n_links) for every document row.

    ``keeper`` is the key of the row that stands for the class: the one with
    the least id. Rows without links have a null class.
    """
    sig = signatures(docs)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    reps = materialize(sig.where("rep is not null").groupBy("rep").agg(
        F.min(order).alias("first"), F.count("*").alias("copies"), F.first("n_set").alias("n_set"), F.first("sig").alias("sig"),
    ).select("*", F.col("first.key").alias("doc_key")), "ngram-reps")
    found = verified(docs, reps, candidate_edges(reps, recall))
    # Components of one block are stars already; only those compared block by block are joined up across blocks.
    stars = found.where("b is not null and links = 1").select(F.col("b").alias("rep"), F.col("a").alias("label"))
    wide = components(found.where("b is not null and links > 1"), "a", "b", "ngram-class").select(F.col("node").alias("rep"), "label")
    label = stars.union(wide)
    links = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    each = reps.select("rep", "first", "copies").join(label, "rep", "left").join(links, "rep", "left")
    each = each.select(
        "rep", "first", "copies", F.coalesce("label", "rep").alias("class"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    heads = each.groupBy("class").agg(F.min("first").alias("head"), F.sum("copies").alias("class_rows")).where("class_rows > 1")
    linked = each.join(heads, "class").select(
        "rep", "class", "n_links", "class_rows", F.col("head.doc_id").alias("class_id"), F.col("head.key").alias("keeper"))
    return sig.select("doc_id", "key", "rep").join(materialize(linked, "ngram-linked"), "rep", "left")


def near_duplicate_classes(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, class_rows, n_links): one row per document row.

    ``class_id`` is the least id in the document's class (its own id if it is
    alone); ``n_links`` counts the other documents of similarity 0.8 or more.
    """
    found = near_duplicates(docs, recall)
    alone = F.col("class").isNull()
    return found.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_rows", F.lit(1)).alias("class_rows"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def drop_near_duplicates(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """``docs`` with one row of every class, the one with the least id; columns unchanged."""
    found = near_duplicates(docs, recall).where("class is not null")
    # Rows equal in id and text share a key: of those, too, one stays.
    fate = found.groupBy("key").agg(F.max(F.col("key") == F.col("keeper")).alias("keeps"), F.count("*").alias("same"))
    # Rows travel as one struct, so no column of theirs can be mistaken for one of ours.
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), _row_name().alias("key"))
    marked = keyed.join(fate, "key", "left")
    # The join has dealt and sorted the rows by key, so numbering equal rows moves nothing again.
    numbered = marked.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("key")))
    alone = F.col("keeps").isNull()
    return numbered.where(alone | (F.col("keeps") & ((F.col("same") == 1) | (F.col("nth") == 1)))).select("row.*")


# All pairs of texts that share a shingle, and the closure of their links.
ORACLE = f"""
with recursive texts as (
  select row_number() over () as k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents
),
shingled as (
  select distinct k, unnest(case when len(w) between 1 and {WIDTH - 1} then [array_to_string(w, ' ')]
    else [array_to_string(w[i : i + {WIDTH - 1}], ' ') for i in range(1, greatest(len(w) - {WIDTH - 2}, 1))] end) as g from texts
),
sizes as (select k, count(*) as n from shingled group by k),
shared as (select x.k as a, y.k as b, count(*) as n from shingled x join shingled y on x.g = y.g and x.k <> y.k group by all),
links as (
  select a, b from shared s join sizes x on x.k = a join sizes y on y.k = b
  where s.n * {SIMILARITY[1]} >= (x.n + y.n - s.n) * {SIMILARITY[0]}
),
reach(k, other) as (
  select k, k from texts union select reach.k, links.b from reach join links on links.a = reach.other
),
classes as (select reach.k, min(doc_id) as class_id, count(*) as class_rows from reach join texts on texts.k = other group by reach.k),
degrees as (select a as k, count(*) as n_links from links group by a)
select doc_id, class_id, class_rows, coalesce(n_links, 0) as n_links from texts join classes using (k) left join degrees using (k)
"""
