"""Run records: summaries, histories and flat reports of what runs put out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = ("job_name", "ts", "git_commit")


def succeeded() -> Column:
    """An output counts if it is stored somewhere."""
    return F.col("gcs_uri").isNotNull()


def summary(outputs: DataFrame, by: list[str]) -> DataFrame:
    return outputs.groupBy(*by).agg(F.count(F.lit(1)).alias("total_outputs"), F.count_if(succeeded()).alias("successful_outputs"), F.count_if(~succeeded()).alias("failed_outputs"))


def by_variable(outputs: DataFrame) -> DataFrame:
    return outputs.groupBy(*RUN, "variable").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("ts").desc(), "job_name", "git_commit", "variable")


def per_period(outputs: DataFrame, period: str) -> DataFrame:
    """(period, runs, outputs): by ``day``, ``week`` or ``month``; a run is a name, time and commit."""
    start = F.date_trunc(period, F.col("ts").cast("timestamp_ntz")).cast("date").cast("string")
    return outputs.groupBy(start.alias("period")).agg(F.count_distinct(*RUN).alias("runs"), F.count(F.lit(1)).alias("outputs"))


def success_rate(outputs: DataFrame, period: str) -> DataFrame:
    start = F.date_trunc(period, F.col("ts").cast("timestamp_ntz")).cast("date").cast("string")
    return outputs.groupBy(start.alias("period")).agg((F.count_if(succeeded()) / F.count(F.lit(1))).alias("rate"))


def variable_pivot(outputs: DataFrame, variables: list[str]) -> DataFrame:
    """A row for each job and a column for each variable: counts, 0 where there is nothing."""
    return outputs.groupBy("job_name").pivot("variable", variables).agg(F.count(F.lit(1))).na.fill(0)


def documents(outputs: DataFrame) -> DataFrame:
    """A nested record for each run: job_info, execution, outputs in order of their ids."""
    each = F.struct("output_id", "variable", "year", "season", "gcs_uri")
    runs = outputs.groupBy(*RUN).agg(F.array_sort(F.collect_list(each)).alias("outputs"))
    good = F.size(F.filter("outputs", lambda o: o["gcs_uri"].isNotNull()))
    return runs.select(F.struct(*RUN).alias("job_info"), F.struct(F.size("outputs").alias("total_outputs"), good.alias("successful_outputs"), (F.size("outputs") - good).alias("failed_outputs")).alias("execution"), "outputs")


def flat(runs: DataFrame) -> DataFrame:
    """A row for each output with its run's columns; a run without outputs keeps one row."""
    return runs.select("job_info.*", "execution.*", F.explode_outer("outputs").alias("o")).select(*RUN, "total_outputs", "successful_outputs", "failed_outputs", "o.*")


def text_report(runs: DataFrame) -> DataFrame:
    """(job_name, ts, git_commit, report): a run's summary as lines of text."""
    line = lambda name, column: F.concat(F.lit(f"{name}: "), F.coalesce(F.col(column).cast("string"), F.lit("-")))
    report = F.concat_ws("\n", line("job", "job_info.job_name"), line("time", "job_info.ts"), line("commit", "job_info.git_commit"), line("outputs", "execution.total_outputs"), line("failed", "execution.failed_outputs"))
    return runs.select("job_info.*", report.alias("report"))


def together(histories: list[DataFrame]) -> DataFrame:
    """Several histories under one header; columns that one lacks are NULL there."""
    out = histories[0]
    for h in histories[1:]:
        out = out.unionByName(h, allowMissingColumns=True)
    return out


def select(outputs: DataFrame, commit: str | None = None, start: str | None = None, end: str | None = None, failed: bool = False) -> DataFrame:
    """The distinct runs of a commit, of times from start to before end, or with failed outputs."""
    out = outputs
    if commit is not None:
        out = out.where(F.col("git_commit") == commit)
    if start is not None:
        out = out.where(F.col("ts") >= start)
    if end is not None:
        out = out.where(F.col("ts") < end)
    if failed:
        out = out.where(~succeeded())
    return out.select(*RUN).distinct()
