"""Run named jobs in order: ``python -m candlewick.plans.runner --jobs silver,gold --root <folder>``."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame

from candlewick.plans import jobs
from candlewick.schemas import DEFAULT_RULES
from candlewick.session import build_session
from candlewick.sinks.layers import Lake
from candlewick.sources.landing import landed_bars, landed_news, typed_news

log = logging.getLogger(__name__)


@dataclass
class Run:
    """Inputs of a run."""

    lake: Lake
    settings: jobs.Settings = field(default_factory=jobs.Settings)
    bars: DataFrame | None = None
    news: DataFrame | None = None
    tickers: Sequence[str] | None = None


def _bronze(run: Run) -> None:
    jobs.land_bars(run.lake, run.bars, run.settings)
    jobs.land_news(run.lake, run.news, run.settings)


def _each(*names: str) -> Callable[[Run], None]:
    def run_all(run: Run) -> None:
        for name in names:
            JOBS[name](run)

    return run_all


JOBS: dict[str, Callable[[Run], object]] = {
    "bronze": _bronze,
    "silver_indicators": lambda run: jobs.bars_to_indicators(run.lake, run.settings, run.tickers),
    "silver_news": lambda run: jobs.news_to_titles(run.lake, run.settings),
    "silver": _each("silver_indicators", "silver_news"),
    "gold_bars": lambda run: jobs.bars_to_gold(run.lake, run.settings),
    "gold_sentiment": lambda run: jobs.news_to_sentiment(run.lake, run.settings),
    "gold_features": lambda run: jobs.build_features(run.lake, run.settings),
    "gold": _each("gold_bars", "gold_sentiment", "gold_features"),
}
SEQUENCES = {"full": ["bronze", "silver", "gold"], **{name: [name] for name in JOBS}}


def run_jobs(names: Sequence[str], run: Run, known: Mapping[str, Callable[[Run], object]] | None = None) -> dict[str, dict]:
    """Result per job. An unknown job is recorded and skipped; the first failing job ends the run."""
    known = JOBS if known is None else known
    results: dict[str, dict] = {}
    for name in names:
        if name not in known:
            results[name] = {"success": False, "error": "unknown job"}
            continue
        try:
            outcome = known[name](run)
        except Exception as problem:
            log.exception("job %s failed", name)
            results[name] = {"success": False, "error": str(problem)}
            break
        results[name] = {"success": True, "rows": outcome} if isinstance(outcome, int) else {"success": True}
    return results


def rules_from_file(path: str) -> dict[str, dict[str, list[str]]]:
    """Rules as ``{"ticker": {"aliases": [...], "blacklist": [...]}}``; the blacklist may be missing."""
    given = json.loads(Path(path).read_text(encoding="utf-8"))
    return {t: {"aliases": list(r["aliases"]), "blacklist": list(r.get("blacklist") or [])} for t, r in given.items()}


def main(arguments: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="run batch jobs")
    which = parser.add_mutually_exclusive_group(required=True)
    which.add_argument("--jobs", help="comma-separated job names")
    which.add_argument("--sequence", choices=sorted(SEQUENCES))
    parser.add_argument("--root", required=True, help="folder of the layer tables")
    parser.add_argument("--bars", help="folder with landed bars, one sub-folder per ticker")
    parser.add_argument("--news", help="folder with landed news, partitioned by date")
    parser.add_argument("--rules", help="JSON file: ticker to aliases and blacklist; the default rules if not given")
    parser.add_argument("--tickers", help="comma-separated; all if not given")
    for bound in ("bars-from", "bars-to", "news-from", "news-to"):
        parser.add_argument(f"--{bound}", help="date; no bound if not given")
    args = parser.parse_args(arguments)

    spark = build_session()
    tickers = [t.strip() for t in args.tickers.split(",") if t.strip()] if args.tickers else None
    rules = rules_from_file(args.rules) if args.rules else DEFAULT_RULES
    run = Run(Lake(spark, args.root), jobs.Settings(rules=rules), tickers=tickers)
    if args.bars:
        run.bars = landed_bars(spark, args.bars, tickers, args.bars_from, args.bars_to)
    if args.news:
        landed = spark.read.parquet(args.news)
        run.news = typed_news(landed_news(landed, rules, args.news_from, args.news_to))
    names = SEQUENCES[args.sequence] if args.sequence else [n.strip() for n in args.jobs.split(",")]
    results = run_jobs(names, run)
    for name, result in results.items():
        print(f"{name}: {'ok' if result['success'] else result['error']}")
    return 0 if all(r["success"] for r in results.values()) else 1


if __name__ == "__main__":
    raise SystemExit(main())
