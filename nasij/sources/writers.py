"""Writers and report renderers. None replaces what is there unless told."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def report(df: DataFrame, path: str, corpus: str) -> None:
    """One JSON object with its corpus, guarded against another corpus'."""
    from nasij.operators.guards import may_overwrite

    may_overwrite(df.sparkSession, path, corpus)
    df.withColumn("config", F.struct(F.lit(corpus).alias("corpus"))).coalesce(1).write.mode("overwrite").json(path)


def review_csv(df: DataFrame, path: str, order: list) -> None:
    """A queue for people: ordered and in one file, hence for small results."""
    df.orderBy(*order).coalesce(1).write.mode("errorifexists").csv(path, header=True)


def markdown(rows: list, columns: list[str]) -> str:
    """A table; right-to-left cells are wrapped, bars are escaped."""

    def cell(v) -> str:
        s = "" if v is None else f"{v:.4f}".rstrip("0").rstrip(".") if isinstance(v, float) else str(v)
        s = s.replace("|", "\\|").replace("\n", " ")
        return f"<span dir=\"rtl\">{s}</span>" if any("؀" <= c <= "ۿ" for c in s) else s

    head = ["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns)]
    return "\n".join(head + ["| " + " | ".join(cell(r[c]) for c in columns) + " |" for r in rows])


def bars(rows: list, width: int = 46) -> str:
    """A text histogram of rows with lo, hi and n."""
    top = max((r["n"] for r in rows), default=0) or 1
    return "\n".join(f"{r['lo']:8.1f} - {r['hi']:8.1f} | {'#' * round(width * r['n'] / top)} {r['n']}" for r in rows)
