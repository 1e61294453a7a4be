"""Change history: ignore rules, latest commit per file, files that change together."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..session import freed_shuffles, packed_table

#: A commit of more files is never expanded pair by pair.
LARGE = 1000
#: Rare files are looked for where there are more pairs a row than this; below, that costs more than the pairs it saves.
FEW_PAIRS = 4
#: Pairs that are shuffled at once, and how often the commits are read at most to keep to it.
PAIRS_AT_ONCE, ROUNDS = 1 << 26, 8


def ignore_patterns(lines: list[str]) -> list[str]:
    """Patterns of an ignore file: trimmed, without blanks and comments, with forward slashes."""
    trimmed = [line.strip() for line in lines]
    return [line.replace("\\", "/") for line in trimmed if line and not line.startswith("#")]


def _glob_regex(pattern: str) -> str | None:
    """Regular expression of a glob whose ``*`` stops at slashes; None when malformed."""
    out, i = "", 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "*":
            out += "[^/]*"
        elif ch == "?":
            out += "[^/]"
        elif ch == "[":
            end = pattern.find("]", i + 2)
            if end < 0:
                return None
            members = pattern[i + 1:end]
            negated = members.startswith("^")
            body = re.sub(r"([\[\]&\\^])", r"\\\1", members[1:] if negated else members)
            out += "[" + ("^" if negated else "") + body + "]"
            i = end
        else:
            out += re.escape(ch)
        i += 1
    return out


def ignore_regex(patterns: list[str], always: list[str], match_ancestors: bool = True) -> str:
    """One anchored alternation for a whole ignore list (a configuration file, so small)."""
    options = [r"^\.git(/|$)"] + [f"^{re.escape(name)}$" for name in always]
    for pattern in patterns:
        pattern = pattern.strip("/")
        if not pattern:
            continue
        glob = _glob_regex(pattern)
        if glob is not None:
            options.append(f"^{glob}(/|$)" if match_ancestors else f"^{glob}$")
        options.append(f"^{re.escape(pattern)}/")
        if pattern.startswith("*."):
            options.append(f"{re.escape(pattern[1:])}(/|$)")
    return "|".join(options)


def drop_ignored(
    paths: DataFrame,
    patterns: list[str],
    match_ancestors: bool = True,
    always: tuple[str, ...] = (".catalogignore",),
    column: str = "path",
) -> DataFrame:
    """Rows whose path no pattern ignores.

    Tree walks also drop everything below an ignored directory; change sets test the file
    path only (``match_ancestors=False``).
    """
    return paths.where(~F.col(column).rlike(ignore_regex(patterns, list(always), match_ancestors)))


def latest_change(commits: DataFrame) -> DataFrame:
    """Last commit per path (ties: largest commit id)."""
    last = F.max(F.struct("at", "commit_id", "author", "message")).alias("last")
    return commits.groupBy("path").agg(last).select("path", "last.*")


def with_last_change(files: DataFrame, commits: DataFrame) -> DataFrame:
    """Files with author, time and message of their last commit; time falls back to ``modified``."""
    joined = files.join(latest_change(commits), "path", "left")
    return joined.withColumn("at", F.coalesce("at", "modified"))


def _by_commit(rows: DataFrame, large: int) -> tuple[DataFrame, DataFrame | None]:
    """(commit_id, files) of commits of up to ``large`` rows, files once and in order, and the rows of larger ones, None without any.

    Only the rows of small commits are brought together by commit. Sizes are counted by a hash: commits that share one
    may count as large, which changes how they are dealt with and not what is found.
    """
    key = F.when(F.col("commit_id").isNotNull(), F.xxhash64("commit_id"))
    keyed = rows.select("commit_id", "path", key.alias("key"))
    big = packed_table(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > large).select("key"))
    some = not big.isEmpty()
    small = keyed.join(big, "key", "left_anti") if some else keyed
    grouped = small.groupBy("commit_id").agg(F.array_sort(F.collect_set("path")).alias("files"))
    return grouped, keyed.join(big, "key", "left_semi").select("commit_id", "path") if some else None


def change_sets(commits: DataFrame, patterns: list[str] | None = None, large: int = LARGE, **ignore) -> DataFrame:
    """Distinct (commit_id, path) without ignored files.

    What is shuffled is a row per commit, not one per file, but for commits of more than ``large`` files.
    """
    rows = commits.select("commit_id", "path").where("path <> ''")
    if patterns is not None:
        rows = drop_ignored(rows, patterns, match_ancestors=False, **ignore)
    grouped, rest = _by_commit(rows, large)
    sets = grouped.select("commit_id", F.explode("files").alias("path"))
    return sets if rest is None else sets.unionByName(rest.distinct())


def cochange_pairs(changes: DataFrame, min_count: int = fv.COCHANGE_MIN, large: int = LARGE) -> DataFrame:
    """(a, b, n) with a < b: in how many commits both files changed, where n >= min_count.

    Exact, without pairing up the files of a very large commit; ``changes`` is read twice:

    * commits of up to ``large`` files are expanded pair by pair, which is at most ``large``
      pairs per input row. Where that is many, files in fewer than ``min_count`` commits, which
      cannot be part of a pair, are dropped first. Very many pairs are counted in rounds, by
      their first file, so that what is shuffled at a time stays small;
    * commits above that, of which there are at most rows / ``large``, are never expanded.
      Each file keeps the set of large commits it is in. Pairs already known from small commits
      add the size of the intersection of the two sets; pairs known from large commits only are
      formed between whole groups of files with equal sets, and only where the groups share at
      least ``min_count`` large commits, so every row formed from them is a row of the result.
      What is compared beforehand are groups, as many as there are different sets.
    """
    grouped, rest = _by_commit(changes, large)
    files = packed_table(grouped.select("files").where(F.size("files") > 1))
    rows, pairs = _sizes(files)
    if min_count > 1 and pairs > FEW_PAIRS * rows:
        files = packed_table(_without_rare(files, rest, min_count))
        pairs = _sizes(files)[1]
    rounds = min(ROUNDS, -(-pairs // PAIRS_AT_ONCE))
    if rest is not None:
        found = _with_large_commits(_small_pairs(files), rest, min_count)
    elif rounds > 1:
        by_round = [_small_pairs(files, F.pmod(F.xxhash64("a"), F.lit(rounds)) == k) for k in range(rounds)]
        found = reduce(DataFrame.unionByName, [packed_table(found.where(F.col("n") >= min_count)) for found in by_round])
    else:
        found = _small_pairs(files)
    return found.where(F.col("n") >= min_count)


def _sizes(files: DataFrame) -> tuple[int, int]:
    """How many files there are in all commits, and how many pairs."""
    n = F.size("files").cast("bigint")
    with freed_shuffles(files.sparkSession):
        found = files.agg(F.sum(n), F.sum(F.shiftright(n * (n - 1), 1))).first()
    return found[0] or 0, found[1] or 0


def _without_rare(files: DataFrame, rest: DataFrame | None, min_count: int) -> DataFrame:
    """Small commits without the files that are in fewer than ``min_count`` commits of several files."""
    path = F.explode("files").alias("path")
    seen = files.select(path) if rest is None else files.select(path).unionByName(rest.select("path"))
    frequent = seen.groupBy("path").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
    numbered = files.select(F.monotonically_increasing_id().alias("id"), "files").select("id", path)
    return numbered.join(frequent, "path", "left_semi").groupBy("id").agg(F.array_sort(F.collect_list("path")).alias("files")).select("files")


def _small_pairs(commits: DataFrame, which: Column | None = None) -> DataFrame:
    files = F.col("files")
    first = commits.select("files", F.posexplode("files").alias("i", "a"))
    rest = F.slice(files, F.col("i") + 2, F.size(files))
    return (
        (first if which is None else first.where(which))
        .select("a", F.explode(rest).alias("b"))
        .groupBy("a", "b").agg(F.count("*").alias("n"))
    )


def _with_large_commits(small: DataFrame, large_sets: DataFrame, min_count: int) -> DataFrame:
    member = large_sets.groupBy("path").agg(F.array_sort(F.collect_set("commit_id")).alias("in"))
    side = {x: member.select(F.col("path").alias(x), F.col("in").alias(f"in_{x}")) for x in ("a", "b")}
    shared = F.coalesce(F.size(F.array_intersect("in_a", "in_b")), F.lit(0))
    known = small.join(side["a"], "a", "left").join(side["b"], "b", "left").select(
        "a", "b", (F.col("n") + F.when(F.col("in_a").isNull() | F.col("in_b").isNull(), 0).otherwise(shared)).alias("n"))

    # Two sorted sets that share min_count members share one of the members that remain when the
    # last min_count - 1 of each are left out, so only those have to meet.
    groups = member.where(F.size("in") >= min_count).select("in").distinct()
    leading = F.slice("in", F.lit(1), F.size("in") - (min_count - 1))
    by_commit = groups.select("in", F.explode(leading).alias("commit_id"))
    left = by_commit.select("commit_id", F.col("in").alias("in_a"))
    right = by_commit.select("commit_id", F.col("in").alias("in_b"))
    met = left.join(right, "commit_id").select("in_a", "in_b").distinct()
    met = met.withColumn("n", F.size(F.array_intersect("in_a", "in_b")).cast("bigint")).where(F.col("n") >= min_count)
    formed = side["a"].join(met, "in_a").join(side["b"], "in_b").where("a < b").select("a", "b", "n")
    return known.unionByName(formed.join(small, ["a", "b"], "left_anti"))


def both_directions(pairs: DataFrame) -> DataFrame:
    """(file, partner, n) for both orders of every pair."""
    ends = F.array(F.struct(F.col("a").alias("file"), F.col("b").alias("partner")),
                   F.struct(F.col("b").alias("file"), F.col("a").alias("partner")))
    return pairs.select(F.inline(ends), "n")


def related(
    pairs: DataFrame,
    min_count: int = fv.COCHANGE_MIN,
    top_n: int = fv.COCHANGE_TOP,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Partners per file by falling count, then name; ``top_n=0`` keeps all.

    ``existing(path)`` keeps partners that are still there, before the cut. The rank filter is
    applied inside each task before files are brought together.
    """
    found = both_directions(pairs).where(F.col("n") >= min_count)
    if existing is not None:
        found = found.join(existing.select(F.col("path").alias("partner")), "partner", "left_semi")
    if top_n <= 0:
        return found.select("file", "partner", "n")
    order = Window.partitionBy("file").orderBy(F.desc("n"), "partner")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n).select("file", "partner", "n")


def related_relationships(related: DataFrame) -> DataFrame:
    """Partners as relationship rows (source_id, label, target, text)."""
    return related.select(
        F.col("file").alias("source_id"),
        F.concat(F.lit("co-changed ("), F.col("n"), F.lit("x)")).alias("label"),
        F.concat(F.lit("/"), "partner", F.lit(".md")).alias("target"),
        F.col("partner").alias("text"))
