"""Errors as values (QA-QC, QG): each row carries why it must not be loaded and what is doubtful about it.

A cleaner hands its rows and named conditions to an inspection. Standing alone it uses `drop_rejected` or `fail_rejected`, plain filters. A
run gives it an Inspection, which writes the judged rows once, sound and rejected ones apart, counts each reason in that same write,
keeps the rejected rows in a table and hands the sound ones on.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderloom.operators.quality import fail_rows
from orderloom.sources.landed import UNREADABLE
from orderloom.staged import Staged

REASONS, DOUBTS, VERDICT = "__reasons", "__doubts", "__verdict"
Checks = dict[str, Column]
Inspect = Callable[..., DataFrame]


def named(checks: Checks) -> Column:
    """The names of the conditions that hold; unknown ones do not."""
    found = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()]) if checks else F.array()
    return F.array_compact(found.cast("array<string>"))


def judged(rows: DataFrame, rejects: Checks, doubts: Checks | None = None) -> DataFrame:
    """The rows with the reasons that keep them out and the doubts they are loaded with."""
    return rows.withColumns({REASONS: named(rejects), DOUBTS: named(doubts or {})})


def unreadable(rows: DataFrame) -> Checks:
    """The condition that a reader left instead of failing, if it was asked to."""
    return {"the file cannot be read": F.col(UNREADABLE).isNotNull()} if UNREADABLE in rows.columns else {}


def any_of(checks: Checks) -> Column:
    return F.size(named(checks)) > 0


def drop_rejected(rows: DataFrame, rejects: Checks, doubts: Checks | None = None, by_file: str | None = None) -> DataFrame:
    """Rows without a reason; by_file: rows of files of which no row has one."""
    if not rejects:
        return rows
    if by_file is None:
        return rows.filter(~any_of(rejects))
    bad = rows.filter(any_of(rejects)).select(F.col(by_file).alias("__file")).distinct()
    return rows.join(bad, F.col(by_file) == F.col("__file"), "left_anti")


def fail_rejected(rows: DataFrame, rejects: Checks, doubts: Checks | None = None, by_file: str | None = None) -> DataFrame:
    """The query fails on the first row with a reason."""
    return fail_rows(rows, rejects)


class Inspection:
    """Inspects the rows of one source of one feed in one run.

    found     rows per reason and doubt, and files left out, of all inspections so far
    rejects   folder of the rejected rows, shared by all runs; a source repeated in the same run replaces its own
    """

    def __init__(self, stage: Staged, rejects: str, feed: str, source: str, run_ts: datetime):
        self.stage, self.feed, self.source = stage, feed, source
        self.path = f"{rejects}/run={run_ts:%Y%m%dT%H%M%S}/feed={feed}/source={source}"
        self.found: dict[str, int] = {}
        self.files: list[str] = []
        self.last: dict[str, int] = {}
        self.count = 0

    def __call__(self, rows: DataFrame, rejects: Checks, doubts: Checks | None = None, by_file: str | None = None) -> DataFrame:
        """The sound rows, read from where the judged rows were written; by_file: those of files without a rejected row."""
        doubts = doubts or {}
        columns = rows.columns
        seen = Observation()
        counts = [F.count_if(F.array_contains(where, n)).alias(f"{kind}{i}") for kind, where, checks in (
            ("r", F.col(REASONS), rejects), ("d", F.col(DOUBTS), doubts)) for i, n in enumerate(checks)]
        judged_rows = judged(rows, rejects, doubts).observe(seen, F.count(F.lit(1)).alias("n"), *counts)
        verdict = F.when(F.size(REASONS) > 0, "rejected").otherwise("sound")
        written = self.stage(judged_rows.withColumn(VERDICT, verdict), by=VERDICT)
        got = seen.get
        self.last = {"rows": got["n"], **{n: got[f"{kind}{i}"] for kind, checks in (("r", rejects), ("d", doubts)) for i, n in enumerate(checks)}}
        for name, n in self.last.items():
            if n and name != "rows":
                self.found[name] = self.found.get(name, 0) + n
        sound = written.filter(F.col(VERDICT) == "sound").select(*[F.col(f"`{c}`") for c in columns])
        if not any(self.last[n] for n in rejects):
            return sound
        bad = written.filter(F.col(VERDICT) == "rejected")
        self._keep(bad, columns)
        if by_file is None:
            return sound
        files = bad.select(F.col(by_file).alias("__file")).distinct()
        self.files += sorted(r[0] for r in files.collect())  # names of files to be looked at by hand
        return sound.join(files, F.col(by_file) == F.col("__file"), "left_anti")

    def _keep(self, bad: DataFrame, columns: list[str]) -> None:
        place = [F.col(c) if c in columns else F.lit(None).cast(t).alias(c) for c, t in (("source_file", "string"), ("row_no", "bigint"))]
        cells = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns if not c.startswith("__")])).alias("cells")
        bad.select(*place, F.col(REASONS).alias("reasons"), cells).write.mode("overwrite").parquet(f"{self.path}/part={self.count}")
        self.count += 1
