"""Rules on text statistics, and rejection of documents whose statistics do not go together.

Rules. A document fails if it has fewer than LEAST_WORDS words, or if over REPEATED percent of
its words are in five-word windows that occur twice in it.

Method. The other documents are judged by vectors of transformed statistics: the logarithm of
the mean word length, and roots of the shares of symbols, repeated lines and repeated words. For
each language and source a minimum-covariance-determinant estimate gives the centre and the
scatter of the HELD part of its documents that lie closest together: from two starts (medians
with scaled deviations, and the plain moments), each step takes the HELD part nearest to the
last estimate and computes its moments, and the start that ends with the smaller determinant
wins. Documents whose Mahalanobis distance lies beyond the CUT quantile of a normal sample go.

Everything is DataFrame functions. Statistics are computed once and staged; each step is one
aggregation whose groups are reduced per task, so a source with a third of all rows costs no
task more than its own input. Estimates come back by a join on the group.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeloom.session import stage

LEAST_WORDS = 10
REPEATED = 20
WINDOW = 5

HELD = 0.75
STEPS = 3
CUT = 0.99999
#: Documents that an estimate in four coordinates needs. Those of a language and source with fewer
#: are judged by the estimate of their whole language, or else of all documents.
GROUP_ROWS = 25
#: Least standard deviation of each coordinate, so that one that hardly varies decides nothing.
FLOORS = (0.06, 0.06, 0.15, 0.12)

WHITE = r"[\x20\x09-\x0D]+"
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
AXES = range(len(FLOORS))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for each row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in windows of WINDOW words that occur at least twice in an array of words."""

    def covered(places: Column) -> Column:
        """Words under windows that start at the given ascending places."""
        steps = F.transform(
            places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    def twice(pairs: Column) -> Column:
        """Places whose hash a neighbour in the order of hashes has, too."""
        same = F.filter(
            pairs, lambda p, i: (p["h"] == F.get(pairs, i - 1)["h"]) | (p["h"] == F.get(pairs, i + 1)["h"])
        )
        return F.sort_array(F.transform(same, lambda p: p["i"]))

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        found = _let(_let(pairs, twice), covered)
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), found).otherwise(F.lit(0))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )
    return F.when(F.size(words) < WINDOW + 1, F.lit(0)).otherwise(_let(windows, count))


def _statistics(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.regexp_replace(text, WHITE, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            _let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
        )

    return _let(F.array_remove(F.split(text, WHITE), ""), of_words)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``doc_id, keys``, the five statistics and ``base_failed``; keys is an array of group keys.

    Words are runs of characters other than ASCII white space. word_chars counts their code
    points, n_dup_lines the lines with a word that equal an earlier one. Null and empty texts
    have zeros throughout, and fail. A null in ``by`` is a group like any other.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keys = [F.to_json(F.array(*[F.col(f"`{c}`").cast("string") for c in by[:n]])) for n in range(len(by), -1, -1) if n] + [F.lit("")]
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.array(*keys).alias("keys"), _statistics(text).alias("s"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    return rows.select("doc_id", "keys", "s.*").withColumn("base_failed", failed)


def _vector() -> list[Column]:
    """The transformed statistics. Short texts are drawn towards the usual by some average words."""
    words = F.col("n_words") + 20
    return [
        F.log((F.col("word_chars") + 100) / words),
        F.sqrt(F.col("n_symbols") / (F.col("word_chars") + 100)),
        F.sqrt(F.col("n_dup_lines") / (words / 10)),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


def _chi_square(x: float, k: int) -> float:
    """P(X <= x) for a chi-square variable with k degrees of freedom, by its power series."""
    term = total = 1 / math.gamma(k / 2 + 1)
    n = 0
    while term > total * 1e-16:
        n += 1
        term *= x / 2 / (k / 2 + n)
        total += term
    return total * (x / 2) ** (k / 2) * math.exp(-x / 2)


def _chi_square_quantile(p: float, k: int) -> float:
    low, high = 0.0, 500.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_square(middle, k) < p else (low, middle)
    return high


def _consistency() -> float:
    """What the scatter of the nearest HELD part of a normal sample must be multiplied by."""
    p = len(FLOORS)
    return HELD / _chi_square(_chi_square_quantile(HELD, p), p + 2)


def _moments(rows: DataFrame) -> DataFrame:
    """``grp``, centre ``m*``, scatter ``c*`` with floors, and the logarithm of its determinant."""
    found = rows.groupBy("grp").agg(
        *[F.avg(f"x{i}").alias(f"m{i}") for i in AXES],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"v{i}{j}") for i in AXES for j in AXES if j <= i],
    )
    scale = _consistency()
    for i in AXES:  # the lower triangular root, row by row
        for j in range(i + 1):
            rest = reduce(lambda a, k: a - F.col(f"c{i}{k}") * F.col(f"c{j}{k}"), range(j), F.col(f"v{i}{j}") * scale)
            if i == j:
                root = F.sqrt(F.greatest(rest + FLOORS[i] ** 2, F.lit(FLOORS[i] ** 2 / 4)))
            else:
                root = rest / F.col(f"c{j}{j}")
            found = found.withColumn(f"c{i}{j}", root)
    size = sum((F.log(F.col(f"c{i}{i}")) for i in AXES), F.lit(0.0))
    return found.select("grp", *[f"m{i}" for i in AXES], *[f"c{i}{j}" for i in AXES for j in AXES if j <= i], size.alias("size"))


def _spread(rows: DataFrame) -> DataFrame:
    """Like ``_moments``, from medians and median deviations alone."""
    middle = rows.groupBy("grp").agg(*[F.percentile_approx(f"x{i}", 0.5).alias(f"m{i}") for i in AXES])
    away = rows.join(middle, "grp").groupBy("grp").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in AXES],
        *[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5).alias(f"d{i}") for i in AXES],
    )
    roots = [
        (F.sqrt((1.4826 * F.col(f"d{i}")) ** 2 + FLOORS[i] ** 2) if i == j else F.lit(0.0)).alias(f"c{i}{j}")
        for i in AXES for j in AXES if j <= i
    ]
    return away.select("grp", *[f"m{i}" for i in AXES], *roots, F.lit(0.0).alias("size"))


def _distance() -> Column:
    """Squared Mahalanobis distance of x* from the joined estimate, by forward substitution."""
    solved: list[Column] = []
    for i in AXES:
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j, y in enumerate(solved):
            rest = rest - F.col(f"c{i}{j}") * y
        solved.append(rest / F.col(f"c{i}{i}"))
    return sum((y * y for y in solved), F.lit(0.0))


def _with_distance(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    joined = rows.join(estimates, "grp", how)
    return joined.select(*rows.columns, _distance().alias("distance"))


def estimates(rows: DataFrame) -> DataFrame:
    """The estimate of each group of ``grp, x0, x1, ...``."""
    ends = []
    for start in (_spread(rows), _moments(rows)):
        found = stage(start, "estimates")
        for _ in range(STEPS):
            away = _with_distance(rows, found)
            near = away.groupBy("grp").agg(F.percentile_approx("distance", HELD).alias("reach"))
            held = away.join(near, "grp").filter("distance <= reach")
            found = stage(_moments(held), "estimates")
        ends.append(found)
    columns = ends[0].columns
    every = reduce(DataFrame.union, ends)
    best = every.groupBy("grp").agg(F.min_by(F.struct(*columns), "size").alias("best"))
    return stage(best.select("best.*"), "estimates")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed``, ``kept`` and ``distance`` for every row.

    kept is false if the rules fail, else whether the distance is within the cut; distance is
    null where the rules fail, and if fewer than GROUP_ROWS documents pass them in all (these are
    kept). Repeated rows are judged alike. Other columns are not read.
    """
    rows = stage(statistics(docs, id_col, text_col, by), "statistics")
    passed = rows.filter("not base_failed")
    # One row for each language and source: the groups it is part of, and the narrowest large enough.
    sizes = stage(passed.groupBy("keys").count(), "groups")
    within = sizes.select("keys", "count", F.posexplode("keys").alias("level", "grp"))
    large = within.groupBy("grp").agg(F.sum("count").alias("rows")).filter(F.col("rows") >= GROUP_ROWS)
    large = stage(within.join(large, "grp").select("keys", "level", "grp"), "groups")
    named = stage(large.groupBy("keys").agg(F.min_by("grp", "level").alias("grp")), "groups")
    members = large.join(named.select("grp").distinct(), "grp", "left_semi").select("keys", "grp")
    vectors = passed.join(members, "keys").select("grp", *[x.alias(f"x{i}") for i, x in enumerate(_vector())])
    found = estimates(stage(vectors, "vectors"))
    judged = rows.join(named, "keys", "left").withColumns({f"x{i}": x for i, x in enumerate(_vector())})
    judged = _with_distance(judged, found, "left")
    distance = F.when(~F.col("base_failed"), F.col("distance"))
    reach = _chi_square_quantile(CUT, len(FLOORS))
    kept = ~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= reach)
    return judged.select("doc_id", *STATISTICS, "base_failed", kept.alias("kept"), F.sqrt(distance).alias("distance"))
