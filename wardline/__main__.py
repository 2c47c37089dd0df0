"""``spark-submit`` entry: ``python -m wardline gate|preflight|stream|build|test|keys|reconcile|failures|expire``."""

from __future__ import annotations

import argparse
import datetime as dt

from wardline.plans import failures, ingest
from wardline.plans.ingest import Stores, utc_now
from wardline.plans.pipeline import FRESH, Pipeline
from wardline.session import build_session
from wardline.sinks.store import TableStore
from wardline.sources.spine import DEFAULT_DAYS, DEFAULT_START
from wardline.streaming import ingest as stream


def report(df, root: str, name: str) -> None:
    """Write a result below ``root``, replacing the last one."""
    path = f"{root}/reports/{name}"
    df.write.mode("overwrite").parquet(path)
    print(f"{name}: {df.sparkSession.read.parquet(path).count()} rows in {path}")


STEPS = ("preflight", "gate", "stream", "build", "test", "keys", "reconcile", "failures", "expire")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="wardline")
    p.add_argument("step", choices=STEPS)
    p.add_argument("--root", help="folder of all stored tables", required=True)
    p.add_argument("--incoming", help="folder files arrive in")
    p.add_argument("--seeds", help="folder of the reference CSVs")
    p.add_argument("--as-of", type=dt.date.fromisoformat, help="date that counts as today")
    p.add_argument("--full", action="store_true", help="rebuild instead of upsert")
    p.add_argument("--fresh-by", choices=FRESH, default=FRESH[0], help="what a build takes from the landing tables")
    p.add_argument("--calendar-start", default=DEFAULT_START)
    p.add_argument("--calendar-days", type=int, default=DEFAULT_DAYS)
    p.add_argument("--recipients", nargs="*", default=[], help="first recipients of failure alerts")
    p.add_argument("--logs", help="folder of task logs")
    p.add_argument("--failed", help="CSV list of failed tasks")
    p.add_argument("--run", help="id of a gate or failures run that is repeated")
    p.add_argument("--keep", type=int, default=10, help="published states that expire keeps")
    a = p.parse_args(argv)
    spark = build_session()
    stores = Stores(a.root)
    if a.recipients:
        ingest.seed_recipients(spark, stores, a.recipients, utc_now())
    try:
        run_step(spark, stores, a)
    except Exception as error:
        failures.record(spark, stores, failures.of_step(spark, a.step, error), ingest.new_run_id(), utc_now())
        raise


def run_step(spark, stores: Stores, a: argparse.Namespace) -> None:
    if a.step == "preflight":
        diff = ingest.preflight(spark, a.incoming)
        report(diff, a.root, "preflight")
        ingest.problem_count(diff).show()
    elif a.step == "gate":
        print(ingest.run_gate(spark, a.incoming, stores, a.run))
    elif a.step == "stream":
        after = stream.silver_upsert(spark, stores, a.as_of.isoformat() if a.as_of else None)
        query = stream.gate_stream(spark, a.incoming, stores, f"{a.root}/checkpoints/gate", after=after, on_run=print)
        query.awaitTermination()
    elif a.step == "failures":
        report(failures.mine(spark, a.logs, a.failed, stores, a.run or ingest.new_run_id(), utc_now()), a.root, "failures")
    elif a.step == "expire":
        print(f"removed {len(TableStore(spark, a.root).expire(a.keep))} versions")
    else:
        pipeline = Pipeline(spark, stores, a.seeds, a.calendar_start, a.calendar_days, a.fresh_by)
        if a.step == "build":
            pipeline.build(utc_now(), a.as_of, a.full)
        else:
            result = {"test": pipeline.test, "keys": pipeline.check_keys, "reconcile": pipeline.reconcile}[a.step]()
            report(result, a.root, {"test": "tests"}.get(a.step, a.step))


if __name__ == "__main__":
    main()
