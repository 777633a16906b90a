"""Scores of model responses, and what they add up to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.code import FENCE
from lathework.functions.text import Name, col, contains_any, let, or_empty, repetition_ratio


def found_terms(response: Name, terms: Name) -> Column:
    return let(F.lower(or_empty(response)), lambda low: F.filter(col(terms), lambda t: F.contains(low, F.lower(t))))


def missing_terms(response: Name, terms: Name) -> Column:
    return let(F.lower(or_empty(response)), lambda low: F.filter(col(terms), lambda t: ~F.contains(low, F.lower(t))))


def coverage(response: Name, terms: Name) -> Column:
    """The share of terms a response holds, 0 to 1; 0 for an empty response or no terms."""
    share = F.try_divide(F.size(found_terms(response, terms)).cast("double"), F.size(col(terms)))
    return F.when(or_empty(response) == "", F.lit(0.0)).otherwise(F.coalesce(share, F.lit(0.0)))


def keyword_coverage(response: Name, keywords: Name) -> Column:
    return coverage(response, keywords) * 100


def pattern_coverage(response: Name, patterns: Name) -> Column:
    """The share of regular expressions that match, without case."""
    hit = F.filter(col(patterns), lambda p: F.regexp(or_empty(response), F.concat(F.lit("(?i)"), p)))
    return F.coalesce(F.try_divide(F.size(hit).cast("double"), F.size(col(patterns))), F.lit(0.0))


def has_code(response: Name) -> Column:
    return contains_any(or_empty(response), FENCE, "def ", "import ")


def score(response: Name, keywords: Name) -> Column:
    """0 to 100: keywords up to 40, code 30, length 20, no repetition 10; errors and null have 0. Rounded half to even."""
    points = (
        F.least(F.lit(40.0), keyword_coverage(response, keywords) * 0.4) + F.when(has_code(response), 30).otherwise(0) + F.when(F.length(col(response)) > 200, 20).otherwise(0)
        + F.when(repetition_ratio(response) < 20, 10).otherwise(0)
    )
    return F.when(col(response).isNull() | col(response).startswith("Error:"), F.lit(0)).otherwise(F.bround(points).cast("int"))


def winner(base: Name, tuned: Name) -> Column:
    return F.when(col(tuned) > col(base), "finetuned").when(col(base) > col(tuned), "base").otherwise("tie")


def status(difference: Name, band: float = 10) -> Column:
    return F.when(col(difference) > band, "Improved").when(col(difference) < -band, "Regressed").otherwise("Similar")


def verdict(percent: Name) -> Column:
    """What an improvement in per cent amounts to."""
    p = col(percent)
    return F.when(p > 20, "excellent").when(p > 5, "good").when(p > -5, "neutral").otherwise("worse")


def loss_improvement(first: Name, last: Name) -> Column:
    """Per cent by which a loss fell; null where it began at 0."""
    return F.try_divide((col(first) - col(last)) * 100, col(first))


def loss_band(percent: Name) -> Column:
    p = col(percent)
    return F.when(p < 10, "little").when(p <= 80, "good").otherwise("too much")


def pair_models(results: DataFrame, base: str = "base", tuned: str = "tuned") -> DataFrame:
    """(question_id, category, base, tuned, diff) of questions both models answered; the later of repeated answers doesn't count."""
    picked = results.where(F.col("model").isin(base, tuned))
    one = picked.groupBy("question_id").agg(
        F.min("category").alias("category"), F.min(F.when(F.col("model") == base, F.col("score"))).alias("base"), F.min(F.when(F.col("model") == tuned, F.col("score"))).alias("tuned")
    )
    both = one.where(F.col("base").isNotNull() & F.col("tuned").isNotNull())
    return both.withColumn("diff", F.col("tuned") - F.col("base"))


def summary(paired: DataFrame) -> DataFrame:
    """One row over all questions: means, improvement, and how many improved and regressed by over 5."""
    out = paired.agg(
        F.count("*").alias("questions"), F.avg("base").alias("base_mean"), F.avg("tuned").alias("tuned_mean"), F.count_if(F.col("diff") > 5).alias("improved"), F.count_if(F.col("diff") < -5).alias("regressed"),
        F.count_if(F.col("diff") > 0).alias("tuned_wins"), F.count_if(F.col("diff") < 0).alias("base_wins"), F.count_if(F.col("diff") == 0).alias("ties"),
    )
    gain = F.col("tuned_mean") - F.col("base_mean")
    return out.withColumn("gain", gain).withColumn("gain_percent", F.when(F.col("base_mean") > 0, F.try_divide(gain * 100, F.col("base_mean"))).otherwise(0.0))


def by_category(paired: DataFrame) -> DataFrame:
    """Means by category with a flag beyond 5 points."""
    out = paired.groupBy("category").agg(F.avg("base").alias("base_mean"), F.avg("tuned").alias("tuned_mean"), F.avg("diff").alias("diff_mean"))
    return out.withColumn("flag", F.when(F.col("diff_mean") > 5, "up").when(F.col("diff_mean") < -5, "down").otherwise("same"))


def best_categories(categories: DataFrame) -> DataFrame:
    """One row: the category of the best mean and the one that improved most."""
    order = lambda c: F.struct(F.col(c), F.col("category"))
    return categories.agg(F.max_by("category", order("tuned_mean")).alias("best"), F.max_by("category", order("diff_mean")).alias("most_improved"))


def top_improved(paired: DataFrame, k: int = 3) -> DataFrame:
    return paired.orderBy(F.col("diff").desc(), F.col("question_id")).limit(k)


def markdown_report(categories: DataFrame, overall: DataFrame, title: str = "Evaluation") -> DataFrame:
    """(place, line) of a report as Markdown: the overall figures, then a line a category, in the order of ``place``."""
    number = lambda c: F.format_string("%.1f", F.col(c))
    signed = lambda c: F.concat(F.when(F.col(c) >= 0, "+").otherwise(""), number(c))
    head = overall.select(
        F.array(
            F.lit(f"# {title}"), F.lit(""), F.concat(F.lit("Questions: "), F.col("questions").cast("string")),
            F.concat(F.lit("Mean: "), number("base_mean"), F.lit(" -> "), number("tuned_mean"), F.lit(" ("), signed("gain"), F.lit(")")), F.lit(""), F.lit("| category | base | tuned | diff |"), F.lit("|---|---|---|---|"),
        ).alias("lines")
    )
    top = head.select(F.posexplode("lines").alias("at", "line")).select(F.struct(F.lit(0).alias("part"), "at", F.lit("").alias("category")).alias("place"), "line")
    told = F.concat(F.lit("| "), F.coalesce("category", F.lit("")), F.lit(" | "), number("base_mean"), F.lit(" | "), number("tuned_mean"), F.lit(" | "), signed("diff_mean"), F.lit(" |"))
    rest = categories.select(F.struct(F.lit(1).alias("part"), F.lit(0).alias("at"), F.coalesce("category", F.lit("")).alias("category")).alias("place"), told.alias("line"))
    return top.unionByName(rest)


def comparison_report(paired: DataFrame, title: str = "Comparison") -> DataFrame:
    """(place, line) of a report with a line a question (question_id, base, tuned, diff), in the order of ``place``."""
    number = lambda c: F.format_string("%.1f", F.col(c))
    spark = paired.sparkSession
    rows = [((0, n, ""), x) for n, x in enumerate((f"# {title}", "", "| question | base | tuned | diff |", "|---|---|---|---|"))]
    top = spark.createDataFrame(rows, "place struct<part:int,at:int,category:string>, line string")
    told = F.concat(F.lit("| "), F.col("question_id").cast("string"), F.lit(" | "), number("base"), F.lit(" | "), number("tuned"), F.lit(" | "), number("diff"), F.lit(" |"))
    key = F.lpad(F.col("question_id").cast("string"), 20, "0")
    return top.unionByName(paired.select(F.struct(F.lit(1).alias("part"), F.lit(0).alias("at"), key.alias("category")).alias("place"), told.alias("line")))


def write_report(lines: DataFrame, path: str) -> None:
    """The lines of a report as one text file."""
    lines.coalesce(1).sortWithinPartitions("place").select("line").write.mode("overwrite").text(path)
