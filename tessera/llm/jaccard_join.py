"""Exact similarity join of documents' n-gram sets in prefix trees.

Sets with a Jaccard similarity of at least s are linked, and documents get the smallest id reachable by links. Equal sets
are one set from the start. A set, ordered by hash, is cut at fixed points of that order into more runs than two linked
sets can have differences, so linked sets share a run: runs are the compressed edges by which sets are dealt to tasks.
Below 90 percent runs would hold few elements, often one that unrelated sets share too; there, windows of elements that
follow each other in a set take their place. Sets that share a run or window, directly or through others, make a block; no
link leaves a block. Within a block the sets are put, in one order (most frequent n-gram first, so that near copies share long paths), into a prefix tree, which
each set then traverses with its overlap so far: branches whose remaining lengths can't bring the overlap to the bound
are pruned, and a branch under which the bound is met for every set is linked as a whole.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import text as tx
from tessera.llm.common import components, drop, prepare, stage


def shingles(data: np.ndarray, off: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram sets of the texts as (hashes, offsets): 64-bit hashes, distinct and in ascending order in each text. A
    text of fewer words has its whole sequence as the one n-gram; one without words has none."""
    n = len(off) - 1
    starts, ends, doc = tx.word_spans(data, off)
    h = tx.span_hashes(data, starts, ends, lower=True)
    count = np.bincount(doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)])
    key = np.zeros(max(len(h) - words + 1, 0), np.uint64)
    for k in range(words):
        key = tx.mix(key * np.uint64(31) + h[k : k + len(key)])
    whole = np.flatnonzero(doc[: len(key)] == doc[words - 1 :]) if len(key) else np.zeros(0, int)
    key, owner = key[whole], doc[whole]
    few = np.flatnonzero((count > 0) & (count < words))
    if len(few):
        short = []
        for d in few:
            k = np.array([count[d]], np.uint64)
            for x in h[first[d] : first[d + 1]]:
                k = tx.mix(k * np.uint64(37) + x)
            short.append(k)
        key, owner = np.concatenate([key, *short]), np.concatenate([owner, few])
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    if len(key):
        new = np.r_[True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])]
        key, owner = key[new], owner[new]
    return key, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])


class Classes:
    """Size classes with the number of runs that sets of a class are cut into.

    If the smaller of two linked sets has at most a elements, they differ in at most a * (1 - s) / s. A class spans sizes up
    to (1 / s) ** 2 (below 0.9: 1 / s) times its least, so a set's linked larger partner lies in the same class or the next: sets
    are cut for their own class and, as a larger partner, for the class below. More runs than needed (`spare`) let sets with no
    more empty runs than that leave these out; they are so many that a set rarely has more, at the class's least size.
    """

    def __init__(self, percent: int, most: int):
        low, high = [], []
        span = (100 / percent) ** (2 if percent >= 90 else 1)
        # sizes with which two different sets can be linked at all: a * 100 >= percent * (a + 1)
        a = max(1, -(-percent // (100 - percent)) if percent < 100 else most + 1)
        while a <= most:
            low.append(a)
            high.append(max(int(a * span), a))
            a = high[-1] + 1
        self.low, self.high = np.array(low, np.int64), np.array(high, np.int64)
        least = self.high * (100 - percent) // percent + 1
        self.runs = least + 1
        for _ in range(400):  # a run in twenty at a time, until the filled runs suffice with a margin
            empty = self.runs * np.exp(-self.low / self.runs)
            short = (self.runs - empty - 3.5 * np.sqrt(empty) < least) & (self.runs < 4 * least)
            if not short.any():
                break
            self.runs = np.where(short, self.runs + np.maximum(self.runs // 20, 1), self.runs)
        self.spare = self.runs - least

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, "right") - 1


def run_keys(
    key: np.ndarray, at: np.ndarray, classes: Classes, percent: int, frequent: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(keys, set of each): a 64-bit key for each run of each set, for its own class and the class below if partners there
    can be large enough.

    With flags of frequent n-grams, runs are cut from the others, and sets left with too many empty runs are cut from all their
    n-grams besides: of two linked sets either one has few empty runs, and they share one of the first kind that isn't
    empty, or both are cut in the second way too. A set's size counts all its n-grams.
    """
    sizes = np.diff(at)
    own = classes.of(sizes)
    out, owners = [], []
    for down in (0, 1):
        c = own - down
        able = (c >= 0) & (sizes > 0)
        if down:
            able &= np.where(able, percent * sizes <= 100 * classes.high[np.maximum(c, 0)], False)
        sets = np.flatnonzero(able)
        if frequent is not None and len(sets):
            k, o, left = _cut(key, at, sets, c[sets], classes, ~frequent[key >> np.uint64(64 - FREQUENT_BITS)], 1)
            out.append(k)
            owners.append(o)
            sets = left
        if len(sets):
            k, o, _ = _cut(key, at, sets, c[sets], classes, None, 0)
            out.append(k)
            owners.append(o)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owners)


def _cut(key, at, sets, c, classes, use, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the runs of `sets` with the set of each, and the sets with more empty runs than can be spared. Empty runs have keys
    only where `use` doesn't leave elements out, and only in the latter sets."""
    sizes, m = np.diff(at)[sets], classes.runs[c]
    member = np.repeat(np.arange(len(sets)), sizes)
    element = np.repeat(at[sets] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(len(member))
    if use is not None:
        member, element = member[use[element]], element[use[element]]
    value, base = key[element], np.concatenate([[0], np.cumsum(m)])
    run = (((value >> np.uint64(32)) * m[member].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    cell = base[member] + run
    sums = np.zeros(base[-1], np.uint64)
    if len(cell):
        edge = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        sums[cell[edge]] = np.add.reduceat(tx.mix(value), edge)
    owner = np.repeat(np.arange(len(sets)), m)
    number = np.arange(base[-1]) - base[owner]
    empty = sums == 0
    many = np.bincount(owner[empty], minlength=len(sets)) > classes.spare[c]
    shown = ~empty if use is not None else ~empty | many[owner]
    label = (c[owner].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64) + (np.uint64(kind) << np.uint64(60))
    return tx.mix(sums + tx.mix(label))[shown], sets[owner[shown]], sets[many]


class Windows:
    """Lengths of stretches that linked sets share, by the size of a set.

    Two linked sets whose union has u elements differ in at most u * (1 - s) of them, which leave no more than one gap more between them, in
    the order of hashes; in the longest gap, `least(u)` or more elements follow each other in both sets alike. `uses[n, length]` tells that
    a set of n elements can have a partner with which it shares a stretch of that length; from `large` elements on this is `length` alone.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.length = -(-percent // (100 - percent)) if percent < 100 else 1
        self.large = 100 * self.length
        self.uses = np.zeros((self.large + 1, self.length + 1), bool)
        for n in range(1, self.large + 1):
            for u in range(n, 100 * n // percent + 1):
                if self.differences(u):  # else linked sets are equal
                    self.uses[n, min(self.least(u), self.length)] = True

    def differences(self, u):
        return u * (100 - self.percent) // 100

    def least(self, u: int) -> int:
        d = self.differences(u)
        return -(-(u - d) // (d + 1))


def window_keys(key: np.ndarray, at: np.ndarray, windows: Windows, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(keys, set of each): as run_keys, linked sets that aren't equal share a key, which stands for elements that follow each other in both.

    With flags of frequent n-grams, windows are of the others first: shorter ones by a quarter, which a set that keeps enough elements shares with
    all partners. Sets left with too few have windows of all their n-grams besides: of two linked sets either one keeps enough, or both have the
    second kind too.
    """
    sizes = np.diff(at)
    sets = np.arange(len(sizes))
    out, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if frequent is not None and frequent.any():
        owner = np.repeat(sets, sizes)
        use = ~frequent[key >> np.uint64(64 - FREQUENT_BITS)]
        length = max(2, 3 * windows.length // 4)
        k, o = _windows(key[use], owner[use], length, 1)
        out.append(k)
        owners.append(o)
        differ = windows.differences(100 * sizes // windows.percent)  # the most that a set and a partner can
        sets = np.flatnonzero(np.bincount(owner[use], minlength=len(sizes)) < (length - 1) * (differ + 1) + 1 + differ)
    for length in np.flatnonzero(windows.uses.any(0)):
        able = np.zeros(len(sizes), bool)
        able[sets] = windows.uses[np.minimum(sizes[sets], windows.large), length]
        own = np.repeat(able, sizes)
        k, o = _windows(key[own], np.repeat(np.arange(len(sizes)), sizes)[own], int(length), 0)
        out.append(k)
        owners.append(o)
    return np.concatenate(out), np.concatenate(owners)


def _windows(value: np.ndarray, owner: np.ndarray, length: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of windows with the set of each, such that sets which share `length` elements in a row share one: of as many windows in a row as fit into
    that length the one with the least key. A window has half as many elements, and two at least."""
    wide = min(length, max(2, length // 2))
    many = length - wide + 1
    total = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(tx.mix(value), out=total[1:])
    label = tx.mix(np.array([length << 8 | kind], np.uint64))
    k = tx.mix(total[wide:] - total[:-wide] + label) if len(value) >= wide else np.zeros(0, np.uint64)
    first = np.flatnonzero(owner[: len(value) - length + 1] == owner[length - 1 :]) if len(value) >= length else np.zeros(0, np.int64)
    best = np.min([k[first + j] for j in range(many)], axis=0) if len(first) else np.zeros(0, np.uint64)
    taken = np.zeros(len(k), bool)
    for j in range(many):
        taken[first[k[first + j] == best] + j] = True
    return k[taken], owner[: len(k)][taken]


class PrefixTree:
    """Sets of small integers, each in ascending order, as paths of a tree whose edges hold runs of elements.

    A node is [run, children by first element, least and greatest size below, sets ending here, a set of the subtree if
    all of it is linked or None].
    """

    def __init__(self, percent: int):
        self.percent, self.root = percent, [(), {}, 1 << 60, 0, [], None]
        self.parent: list[int] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)

    def insert(self, s: tuple, name: int) -> None:
        node, i, n = self.root, 0, len(s)
        node[5] = None
        while True:
            node[2], node[3] = min(node[2], n), max(node[3], n)
            if i == n:
                node[4].append(name)
                return
            child = node[1].get(s[i])
            if child is None:
                node[1][s[i]] = [s[i:], {}, n, n, [name], name]
                return
            run, k = child[0], 1
            most = min(len(run), n - i)
            while k < most and run[k] == s[i + k]:
                k += 1
            if k < len(run):  # split the edge
                upper = [run[:k], {run[k]: child}, child[2], child[3], [], child[5]]
                child[0] = run[k:]
                node[1][s[i]] = child = upper
            child[5] = None
            node, i = child, i + k

    def probe(self, s: tuple, name: int) -> None:
        """Links set `name`, not yet inserted, with every set of the tree it is similar to."""
        n, percent = len(s), self.percent
        # node, elements of s used, elements of the path, overlap
        todo = [(child, 0, 0, 0) for child in self.root[1].values()]
        while todo:
            node, i, depth, both = todo.pop()
            if node[5] is not None and self.find(node[5]) == self.find(name):
                continue  # the subtree and s are linked already
            if percent * n > 100 * node[3] or percent * node[2] > 100 * n:
                continue  # all sizes below are too small or too large
            run = node[0]
            least = max(node[2], -(-percent * n // 100))  # smallest size below that can be similar
            need = -(-percent * (n + least) // (100 + percent))
            spare_s, spare_t = n - need, node[3] - need
            missed_s, missed_t = i - both, depth - both
            alive = True
            for e in run:
                while i < n and s[i] < e:
                    i += 1
                    missed_s += 1
                if i < n and s[i] == e:
                    i += 1
                    both += 1
                else:
                    missed_t += 1
                if missed_s > spare_s or missed_t > spare_t:
                    alive = False  # what remains can't bring the overlap to the bound
                    break
            if not alive:
                continue
            depth += len(run)
            if both * (100 + percent) >= percent * (n + node[3]):
                self._link_all(node, name)  # enough even for the largest set below
                continue
            for t in node[4]:
                if both * (100 + percent) >= percent * (n + depth):
                    self.union(name, t)
            for child in node[1].values():
                todo.append((child, i, depth, both))

    def _link_all(self, node: list, name: int) -> None:
        todo = [node]
        while todo:
            x = todo.pop()
            if x[5] is not None:
                self.union(name, x[5])
                continue
            for t in x[4]:
                self.union(name, t)
            todo.extend(x[1].values())
        node[5] = name


def link_sets(sets: list[np.ndarray], percent: int, silent: int = 0) -> list[int]:
    """For each set (distinct hashes), the first set it is linked to directly or through others. The first `silent` sets aren't compared
    with each other."""
    if not sets:
        return []
    values, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -count))] = np.arange(len(values))
    coded, at = rank[inverse], np.cumsum([0, *map(len, sets)])
    tree = PrefixTree(percent)
    tree.parent = list(range(len(sets)))
    for k, (a, b) in enumerate(pairwise(at)):
        s = tuple(np.sort(coded[a:b]).tolist())
        if k >= silent:
            tree.probe(s, k)
        tree.insert(s, k)
    return [tree.find(k) for k in range(len(sets))]


def star_links(key: np.ndarray, at: np.ndarray, pivots: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """(set, pivot) for all sets that are similar to one of the few pivots among them, as a pivot is to itself."""
    out, sizes = [], np.diff(at)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for p in pivots.tolist():
        own = key[at[p] : at[p + 1]]  # in ascending order
        place = np.minimum(np.searchsorted(own, key), max(len(own) - 1, 0))
        both = np.bincount(owner[own[place] == key], minlength=len(sizes)) if len(own) else np.zeros(len(sizes), np.int64)
        linked = (both > 0) & ((100 + percent) * both >= percent * (sizes + len(own)))
        out += [(k, p) for k in np.flatnonzero(linked).tolist()]
    return out


#: Bits by which frequent n-grams are told, and how many of them at most: both bound what is broadcast.
FREQUENT_BITS, MOST_FREQUENT = 24, 1 << 20


def frequent(source: DataFrame, words: int, least: int = 32, in_batch: int = 3) -> np.ndarray:
    """A table of 2 ** FREQUENT_BITS flags, set for the n-grams found in many documents (and the few others that share a flag).

    Any set will do: n-grams left out of all runs alike can only make the differences of two sets fewer. Leaving out those of
    passages that many documents share keeps such documents out of each other's blocks. A task sends the n-grams of
    in_batch documents or more of a batch; the most frequent with `least` documents in all are taken, no more than MOST_FREQUENT.
    """

    def run(batches):
        for b in batches:
            key, _ = shingles(*tx.buffers(b.column(0)), words)
            value, n = np.unique(key, return_counts=True)
            many = n >= in_batch
            yield pa.RecordBatch.from_arrays([pa.array(value[many].view(np.int64)), pa.array(n[many].astype(np.int64))], ["gram", "n"])

    total = source.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    total = stage(total.where(F.col("n") >= least), "jaccard-frequent")
    # the lowest frequency (in steps of a quarter octave) from which there are no more than MOST_FREQUENT
    level = F.floor(F.log2("n") * 4).alias("level")
    counts = sorted(total.groupBy(level).count().collect(), reverse=True)  # some 250 rows at most
    taken, low = 0, None
    for k, n in counts:
        taken += n
        if taken > MOST_FREQUENT:
            break
        low = k
    top = total.where(level >= low if low is not None else F.lit(False)).select("gram").toPandas()
    flags = np.zeros(1 << FREQUENT_BITS, bool)
    flags[top["gram"].to_numpy(np.int64).view(np.uint64) >> np.uint64(64 - FREQUENT_BITS)] = True
    return flags


def cluster(
    docs: DataFrame,
    words: int = 3,
    percent: int = 90,
    text: str = "text",
    most_shingles: int = 1 << 31,
    block_shingles: int = 50_000,
    pivots: int = 8,
    leave_out_frequent: bool | None = None,
    parts: int = 4,
) -> DataFrame:
    """doc_id, n_shingles and component_id of every document: the smallest doc_id reachable by links, itself included.

    Documents link when 100 * intersection >= percent * union of their sets of `words`-word n-grams (A-Z lower-cased).
    Blocks of more than block_shingles elements are split. First all sets of such a block are compared with a few `pivots` of it, which
    takes tasks in proportion to its size. What that joins to the largest component is most of a group of near copies and needs
    no comparison within itself; the sets outside are compared with all of the block, each pair of parts in a task of its own.
    leave_out_frequent: cut runs and windows from the less frequent n-grams only, which takes a pass more; by default below 90 percent,
    where they are so short that documents with a passage in common would share some.
    Runs and windows go in `parts` parts, one after another, so that their shuffle needs that share of the disk.

    Null, empty and wordless texts have the empty set, linked with nothing. Rows without doc_id have no identity and are
    left out. Repeated rows are one document with one row for each; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    classes, windows = (Classes(percent, most_shingles), None) if percent >= 90 else (None, Windows(percent))
    source = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))

    if leave_out_frequent is None:
        leave_out_frequent = percent < 90
    flags = source.sparkSession.sparkContext.broadcast(np.packbits(frequent(source, words))) if leave_out_frequent else None  # 2 MB

    def mark(batches):
        seen: set = set()
        known = np.unpackbits(flags.value).view(bool) if flags else None
        for b in batches:
            key, at = shingles(*tx.buffers(b.column(1)), words)
            sizes = np.diff(at)
            f1, f2 = prints(key, at)
            fresh = np.zeros(len(sizes), bool)
            for k, f in enumerate(zip(f1.tolist(), f2.tolist())):
                if sizes[k] and f not in seen:  # copies within a task are dealt once
                    seen.add(f)
                    fresh[k] = True
            chosen = np.flatnonzero(fresh)
            part = np.concatenate([key[at[k] : at[k + 1]] for k in chosen]) if len(chosen) else key[:0]
            at_chosen = np.concatenate([[0], np.cumsum(sizes[chosen])]).astype(np.int64)
            runs, owner = run_keys(part, at_chosen, classes, percent, known) if classes else window_keys(part, at_chosen, windows, known)
            order = np.argsort(owner, kind="stable")
            n = np.zeros(len(sizes), np.int64)
            if len(chosen):
                n[chosen] = np.bincount(owner, minlength=len(chosen))
            ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), pa.array(sizes), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(runs[order].view(np.int64))),
                ],
                ["doc_id", "n_shingles", "f1", "f2", "runs"],
            )

    cut = stage(source.mapInArrow(mark, "doc_id long, n_shingles long, f1 long, f2 long, runs array<long>"), "jaccard-cut")
    least = None
    for k in range(parts):
        # a run's sets are joined to the least of them, which makes one row for each, not one for each pair
        runs = cut.select("f1", F.explode(F.filter("runs", lambda r: F.pmod(r, F.lit(parts)) == k)).alias("run"))  # noqa: B023
        runs = runs.withColumn("least", F.expr("min(f1) over (partition by run)")).where("f1 <> least").select(F.col("f1").alias("a"), F.col("least").alias("b"))
        runs = stage(runs.distinct(), "jaccard-runs")
        least = runs if least is None else least.unionByName(runs)
    marks = stage(cut.drop("runs"), "jaccard-marks")
    drop(cut)
    sets = marks.where("n_shingles > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"))
    member = stage(components(least), "jaccard-blocks")
    sets = stage(sets, "jaccard-sets")
    picked = stage(sets.join(member.withColumnRenamed("node", "f1"), "f1").withColumnRenamed("component", "block"), "jaccard-picked")

    weight = picked.groupBy("block").agg(F.sum("n").alias("w")).where(F.col("w") > block_shingles)
    large = stage(weight.select("block", F.ceil(F.col("w") / (block_shingles / 2)).cast("int").alias("parts")), "jaccard-large")

    def sets_of(t: pa.Table, flag: str):
        """(n-grams, bounds, rep, flag) of the distinct sets in t, flagged ones last, else in order of size."""
        key, at = shingles(*tx.buffers(t.column("text")), words)
        f1, f2 = prints(key, at)
        rep, marked = t.column("rep").to_numpy(), t.column(flag).to_numpy(zero_copy_only=False).astype(bool)
        right = (f1.view(np.int64) == t.column("f1").to_numpy()) & (f2.view(np.int64) == t.column("f2").to_numpy())
        use = np.flatnonzero(right)  # a repeated doc_id may bring another text
        use = use[np.lexsort((~marked[use], f2[use], f1[use]))]
        use = use[np.r_[True, (f1[use][1:] != f1[use][:-1]) | (f2[use][1:] != f2[use][:-1])][: len(use)]]
        use = use[np.lexsort((rep[use], np.diff(at)[use], marked[use]))]
        return [key[at[k] : at[k + 1]] for k in use], rep[use], marked[use]

    def with_texts(dealt: DataFrame) -> DataFrame:
        # a sort-merge join at every size: the picked sets are a share of all documents, so they outgrow any broadcast
        return dealt.hint("merge").join(source.withColumnRenamed("doc_id", "rep").select("rep", "text"), "rep")

    def star(t: pa.Table) -> pa.Table:
        sets, rep, pivot = sets_of(t, "pivot")
        bounds = np.cumsum([0, *map(len, sets)])
        found = star_links(np.concatenate(sets), bounds, np.flatnonzero(pivot), percent) if sets else []
        block = np.full(len(found), t.column("block")[0].as_py() if len(t) else 0, np.int64)
        return pa.table({"block": pa.array(block), "a": pa.array([rep[k] for k, _ in found], pa.int64()), "b": pa.array([rep[p] for _, p in found], pa.int64())})

    def united(t: pa.Table) -> pa.Table:
        """The pivots of a block (a few) with the least one each is connected to through sets near to both."""
        a, b = t.column("p").to_pylist(), t.column("q").to_pylist()
        root = {x: x for x in (*a, *b)}
        for _ in root:
            for x, y in zip(a, b):
                root[x] = root[y] = min(root[x], root[y])
        return pa.table({"block": pa.array([t.column("block")[0].as_py()] * len(root), pa.int64()), "q": pa.array(list(root), pa.int64()), "c": pa.array(list(root.values()), pa.int64())})

    def join(t: pa.Table) -> pa.Table:
        sets, rep, probing = sets_of(t, "probing")
        first = link_sets(sets, percent, int((~probing).sum()))
        return pa.table({"a": pa.array(rep), "b": pa.array(rep[np.array(first, np.int64)] if len(sets) else rep)})

    columns = ["block", "cell", "f1", "f2", "rep"]
    dealt = picked.join(large, "block", "left_anti").withColumn("cell", F.lit(0)).select(*columns, F.lit(True).alias("probing"))
    near = None
    if not large.isEmpty():
        h = F.xxhash64("f2", "f1")
        crowd = stage(picked.join(large, "block"), "jaccard-crowd")
        # the set of the smallest document and others by hash, found by minima in each task
        order = F.struct(F.pmod(h, F.lit(pivots - 1)).alias("slot"), h.alias("h"))
        chosen = crowd.groupBy("block", order["slot"].alias("slot")).agg(F.min(F.struct(h.alias("h"), "f1", "f2", "rep", "parts")).alias("p"))
        chosen = chosen.unionByName(crowd.groupBy("block").agg(F.min(F.struct("rep", "f1", "f2", "parts")).alias("p")).select("block", F.lit(-1).cast("long").alias("slot"), F.struct(F.lit(0).cast("long").alias("h"), "p.f1", "p.f2", "p.rep", "p.parts").alias("p")))
        chosen = chosen.select("block", "p.f1", "p.f2", "p.rep", "p.parts").distinct()
        to_all = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("cell")
        one = F.pmod(h, F.col("parts")).cast("int").alias("cell")
        stars = chosen.select("block", to_all, "f1", "f2", "rep", F.lit(True).alias("pivot")).unionByName(crowd.select("block", one, "f1", "f2", "rep", F.lit(False).alias("pivot")))
        near = stage(with_texts(stars).groupBy("block", "cell").applyInArrow(star, "block long, a long, b long").distinct(), "jaccard-stars")
        to = near.groupBy("block", "a").agg(F.min("b").alias("p"), F.collect_set("b").alias("qs"))  # a few pivots each
        pairs = to.select("block", "p", F.explode("qs").alias("q")).distinct()
        roots = pairs.groupBy("block").applyInArrow(united, "block long, q long, c long")
        joined = to.select("block", F.col("a").alias("rep"), F.col("p").alias("q")).join(roots, ["block", "q"]).select("block", "rep", "c")
        crowd = crowd.join(joined, ["block", "rep"], "left").withColumn("c", F.coalesce("c", "rep"))
        crowd = stage(crowd, "jaccard-crowd")
        near = near.select("a", "b")
        hubs = crowd.groupBy("block", "c").agg(F.count("*").alias("k")).groupBy("block").agg(F.max(F.struct("k", "c"))["c"].alias("hub"))
        rest = crowd.join(hubs, "block").where("c <> hub")
        parts = rest.groupBy("block").agg(F.ceil(F.sum("n") / (block_shingles / 2)).cast("int").alias("own"))
        rest = rest.join(parts, "block")
        every = crowd.join(parts, "block")
        mine, other = F.pmod(h, F.col("own")).cast("int"), F.pmod(F.xxhash64("f1", "f2"), F.col("parts")).cast("int")
        cell = lambda i, j: (i * F.col("parts") + j).alias("cell")
        rest = rest.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("block", cell(mine, F.col("j")), "f1", "f2", "rep", F.lit(True).alias("probing"))
        every = every.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("own") - 1))).select("block", cell(F.col("i"), other), "f1", "f2", "rep", F.lit(False).alias("probing"))
        dealt = dealt.unionByName(rest).unionByName(every)
    rows = with_texts(dealt)
    edges = stage(rows.groupBy("block", "cell").applyInArrow(join, "a long, b long"), "jaccard-links")
    found = components(edges if near is None else edges.unionByName(near))
    named = sets.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("f1", "f2", F.coalesce("component", "rep").alias("component_id"))
    named = stage(named, "jaccard-named")
    out = marks.select("doc_id", "n_shingles", "f1", "f2").join(named, ["f1", "f2"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def prints(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of each set: sums of its elements scrambled in two ways, scrambled with its size."""
    total = np.zeros(len(key) + 1, np.uint64)
    out = []
    for salt in (np.uint64(0x1B873593), np.uint64(0xCC9E2D51)):
        np.cumsum(tx.mix(key ^ salt), out=total[1:])
        out.append(tx.mix((total[at[1:]] - total[at[:-1]]) + tx.mix(np.diff(at).astype(np.uint64) + salt)))
    return out[0], out[1]


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stand for their component (one document of each group), with docs' own columns. Rows whose
    set is empty and rows without doc_id stay."""
    columns = docs.columns
    dropped = cluster(docs, **options).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(stage(dropped, "jaccard-dropped"), "doc_id", "left_anti").select(*columns)
