"""Line dedup by a segment-partition edit join, in DataFrame functions only.

A line goes if an earlier line of the corpus (smaller doc_id, then smaller line number) is equal to it or within its budget of
character edits: one for every `per_edit` characters of the shorter line, `edits` at most. Lines are judged on the input, not on what
is left. Equal lines are grouped by 128-bit hash.
For the others, a line cut into budget + 1 segments keeps one segment unharmed by so many edits: every distinct line puts
its segments into an index under its length, and probes the index of each length it can be near to with the substrings
that the segment can have moved to. Candidates are verified by a banded edit distance, bit-parallel over the band.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh, prepare, stage


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(gap, segment, shift) of the substrings that can equal a segment of a line of the same length or up to `edits` shorter.

    For segment k (from 0) of a line that is `gap` shorter, counting edits from the left bounds the shift to
    [-k, k], and from the right to gap + [-(edits - k), edits - k]; only shifts in both are probed.
    """
    return [
        (gap, k, shift)
        for gap in range(edits + 1)
        for k in range(edits + 1)
        for shift in range(max(-k, gap - (edits - k)), min(k, gap + edits - k) + 1)
    ]


def keyed(lines: DataFrame, edits: int, per_edit: int) -> DataFrame:
    """(id, key, probing) for each line's segments and probes of each budget that it can have with another; key is null where a
    substring would lie outside its line, or where the shorter line's length is of another budget."""
    names = ("budget", "least", "most", "gap", "k", "shift", "probing")
    length, none = F.char_length("line"), F.array().cast("array<struct<budget:int,least:int,most:int,gap:int,k:int,shift:int,probing:boolean>>")
    parts = []
    for e in range(1, edits + 1):
        least, most = e * per_edit, (e + 1) * per_edit - 1 if e < edits else (1 << 31) - 1 - edits
        cuts = [(e, least, most, 0, k, 0, False) for k in range(e + 1)] + [(e, least, most, *p, True) for p in probes(e)]
        parts.append(F.when(length.between(least, most + e), F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, c)]) for c in cuts])).otherwise(none))
    rows = lines.select("id", "line", length.alias("length"), F.explode(F.concat(*parts)).alias("c")).select("id", "line", "length", "c.*")
    rows = rows.withColumn("shorter", F.col("length") - F.col("gap")).where("shorter between least and most")
    rows = rows.withColumn("short", F.expr("shorter div (budget + 1)").cast("int")).withColumn("longer", F.expr("shorter % (budget + 1) - (budget + 1) + k"))
    # the last shorter % (budget + 1) segments are one character longer
    rows = rows.withColumn("start", F.expr("short * k + greatest(longer, 0) + 1 + shift")).withColumn("n", F.expr("short + if(longer >= 0, 1, 0)"))
    key = F.when((F.col("start") >= 1) & (F.col("start") + F.col("n") - 1 <= F.col("length")), F.xxhash64("shorter", "k", F.substring("line", F.col("start"), F.col("n"))))
    return rows.select("id", key.alias("key"), "probing")


#: Characters whose counts part lines that only share a segment: an edit changes their sum of differences by two at most.
COUNTED = " abcdefghijklmnopqrstuvwxyz"


def counts_of(line: Column) -> Column:
    return F.array(*[F.char_length(line) - F.char_length(F.replace(line, F.lit(c), F.lit(""))) for c in COUNTED])


def near_counts(a: Column, b: Column, edits: int) -> Column:
    total = F.abs(a[0] - b[0])
    for k in range(1, len(COUNTED)):
        total = total + F.abs(a[k] - b[k])
    return total <= 2 * edits


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def within(a: Column, b: Column, edits: int, budget: Column | None = None) -> Column:
    """Whether a and b are within `edits` edits, or within a budget of no more: Wu and Manber's automaton along b, one word for each number of errors, whose
    bits are the 2 * edits + 1 diagonals of the band. A fold over b's characters; a's are looked up by position."""
    wide = 2 * edits + 1
    # before any character of b, d errors reach the diagonals of up to d deletions
    first = [sum(1 << (edits + k) for k in range(d + 1)) for d in range(edits + 1)]
    start = F.struct(F.lit(0).alias("j"), *[F.lit(v).alias(f"r{d}") for d, v in enumerate(first)])

    def mask(x: Column, j: Column, ch: Column) -> Column:
        """Bit k is set where a has ch on diagonal k - edits."""
        bits = F.lit(0)
        for k in range(wide):
            i = j + (k - edits)
            bits = bits.bitwiseOR(F.when((i >= 0) & (F.get(x, i) == ch), F.lit(1 << k)).otherwise(F.lit(0)))
        return bits

    def words(s: Column, match: Column) -> Column:
        new: list[Column] = []
        for d in range(edits + 1):
            r = s[f"r{d}"].bitwiseAND(match)
            if d:  # a changed, an added and a lost character
                less = s[f"r{d - 1}"]
                r = r.bitwiseOR(less).bitwiseOR(F.shiftright(less, 1)).bitwiseOR(F.shiftleft(new[d - 1], 1))
            new.append(r.bitwiseAND(F.lit((1 << wide) - 1)))
        return F.struct((s["j"] + 1).alias("j"), *[w.alias(f"r{d}") for d, w in enumerate(new)])

    end = _let(F.split(a, ""), lambda x: F.aggregate(F.split(b, ""), start, lambda s, ch: _let(mask(x, s["j"], ch), lambda m: words(s, m))))
    gap = F.char_length(a) - F.char_length(b)
    bit = F.get(F.array(*[F.lit(1 << k) for k in range(wide)]), gap + edits)  # null beyond the band
    word = end[f"r{edits}"]
    if budget is not None:
        word = _let(end, lambda w: F.get(F.array(*[w[f"r{d}"] for d in range(edits + 1)]), budget))
    return F.coalesce(word.bitwiseAND(bit) > 0, F.lit(False))


def lines_of(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """doc_id, no, line: the lines that count, of min_chars characters or more and with one other than white space."""
    lines = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(F.col(text), "\n")).alias("no", "line"))
    return lines.where((F.char_length("line") >= min_chars) & F.col("line").rlike("[^\\x20\\x09-\\x0D]"))


def removed_lines(docs: DataFrame, edits: int = 2, per_edit: int = 10, text: str = "text", exact_chars: int = 1) -> DataFrame:
    """doc_id, no, exact: the lines to remove, as numbers from 0 in their documents. Exact copies are found among lines of exact_chars
    characters or more."""
    prepare(docs.sparkSession)
    marks = lines_of(docs, text, min(exact_chars, per_edit)).select(
        "doc_id", "no", (F.char_length("line") >= per_edit).alias("long"), (F.char_length("line") >= exact_chars).alias("whole"),
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line", F.char_length("line")).alias("h2"),
    )
    marks = stage(marks, "line-marks")
    distinct = stage(marks.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "no")).alias("first"), F.count("*").alias("n"), F.first("long").alias("long")), "line-distinct")
    copies = (
        marks.where("whole").join(distinct.where("n > 1").select("h1", "h2", "first"), ["h1", "h2"])
        .where(F.struct("doc_id", "no") > F.col("first"))
        .select("doc_id", "no", F.lit(True).alias("exact"))
    )

    # the distinct lines that meet under a key, as index or as probe
    firsts = distinct.where("long").groupBy("first.doc_id").agg(F.collect_list("first.no").alias("nos"))
    keys = keyed(_chosen_lines(docs, stage(firsts, "line-firsts"), text), edits, per_edit)
    met = (
        keys.where("key is not null")
        .withColumn("low", F.expr("min(id) over (partition by key)")).withColumn("high", F.expr("max(id) over (partition by key)"))
        .where("low <> high").select("key", "id", "probing")
    )
    met = stage(met, "line-met")

    wanted = met.select("id").distinct().groupBy("id.doc_id").agg(F.collect_list("id.no").alias("nos"))
    lines = _chosen_lines(docs, stage(wanted, "line-docs"), text).distinct().withColumn("c", counts_of(F.col("line")))
    lines = stage(lines, "line-texts")
    met = stage(met.join(lines.select("id", "c"), "id"), "line-counts")

    # first each line against the first line it meets under a key, a row for each line and key; then only lines that this
    # leaves, against the other earlier lines they meet. Pairs whose counts differ too much are never made.
    other = F.min(F.struct(F.col("id").alias("other"), F.col("c").alias("d"))).alias("o")
    least = stage(met.groupBy("key", (~F.col("probing")).alias("probing")).agg(other, F.count("*").alias("n")).select("key", "probing", "n", "o.*"), "line-least")
    near_to = (F.col("other") < F.col("id")) & near_counts(F.col("c"), F.col("d"), edits)
    tries = stage(met.join(least, ["key", "probing"]).where(near_to).select("id", "other").distinct(), "line-tries")
    near = stage(_verified(tries, lines, edits, per_edit).select("id").distinct(), "line-near")
    rest = met.join(least.where("n > 1").select("key", "probing"), ["key", "probing"], "left_semi").join(near, "id", "left_anti")
    others = met.select(F.col("key").alias("key2"), F.col("probing").alias("probing2"), F.col("id").alias("other"), F.col("c").alias("d"))
    rest = rest.join(others, (F.col("key") == F.col("key2")) & (F.col("probing") != F.col("probing2")) & near_to).select("id", "other").distinct()
    rest = stage(rest.join(tries, ["id", "other"], "left_anti"), "line-rest")
    near = near.unionByName(_verified(rest, lines, edits, per_edit).select("id").distinct())
    # the copies of a removed line come after it and are exact copies already
    return copies.unionByName(near.select("id.doc_id", "id.no", F.lit(False).alias("exact")))


def _chosen_lines(docs: DataFrame, chosen: DataFrame, text: str) -> DataFrame:
    """(id, line) of the lines of numbers `nos` in `chosen`, a row for each document. By a sort-merge join at every size, as
    the chosen are a share of all documents."""
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = texts.join(chosen.hint("merge"), "doc_id").select("doc_id", "nos", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    return rows.where(F.array_contains("nos", F.col("no"))).select(F.struct("doc_id", "no").alias("id"), "line")


def _verified(pairs: DataFrame, lines: DataFrame, edits: int, per_edit: int) -> DataFrame:
    """The pairs (id, other) of lines within their budget of edits."""
    both = pairs.join(lines.select("id", "line"), "id").join(lines.select(F.col("id").alias("other"), F.col("line").alias("line2")), "other")
    budget = F.least(F.lit(edits), F.floor(F.least(F.char_length("line"), F.char_length("line2")) / per_edit).cast("int"))
    return both.where(within(F.col("line"), F.col("line2"), edits, budget)).select("id", "other")


def dedup(docs: DataFrame, edits: int = 2, per_edit: int = 10, text: str = "text", exact_chars: int = 1) -> DataFrame:
    """docs with the lines removed from the text and columns n_lines, n_copies, n_near (lines of the input, those removed as
    copies, those removed as near copies); columns of these names are replaced.

    Lines are parted by \\n; lines without a word stay, and lines of fewer than per_edit characters have exact copies only. Null texts stay null with
    no lines, and rows without doc_id stay as they are. Of repeated rows with one doc_id all lose the lines that any loses by number.
    An empty table gives no rows.
    """
    columns = [c for c in docs.columns if c not in {"n_lines", "n_copies", "n_near"}]
    ident, copies, near = (fresh(docs, n) for n in ("id", "copies", "near"))
    gone = removed_lines(docs, edits, per_edit, text, exact_chars).groupBy(F.col("doc_id").alias(ident)).agg(
        F.collect_set(F.when(F.col("exact"), F.col("no"))).alias(copies), F.collect_set(F.when(~F.col("exact"), F.col("no"))).alias(near)
    )
    gone = stage(gone, "line-gone")
    none = F.array().cast("array<int>")
    out = docs.join(gone.hint("merge"), docs["doc_id"].cast("long") == gone[ident], "left")
    drop = F.coalesce(F.array_union(copies, near), none)
    lines = F.split(F.col(text), "\n")
    left = F.when(F.size(drop) == 0, F.col(text)).otherwise(F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(drop, i)), "\n"))
    return out.select(
        *[left.alias(c) if c == text else F.col(c) for c in columns],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size(copies), F.lit(0)).cast("long").alias("n_copies"),
        F.coalesce(F.size(near), F.lit(0)).cast("long").alias("n_near"),
    )
