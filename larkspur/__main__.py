"""python -m larkspur build | mirror | stage | hydrate | upload | inspect | report"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from larkspur.plans import snapshot
from larkspur.plans import stage as staging
from larkspur.plans.config import Config
from larkspur.sources import kv


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="larkspur", description=__doc__)
    p.add_argument("command", choices=["build", "mirror", "stage", "hydrate", "upload", "inspect", "report"])
    p.add_argument("--config")
    for name, kind in (("source", str), ("work-dir", str), ("snapshot-date", str), ("memory-limit", str), ("batch-size", int), ("mirror-concurrency", int), ("backup-id", int), ("chunks", int)):
        p.add_argument(f"--{name}", type=kind)
    p.add_argument("--chunk-dry-run", action="store_true", default=None)
    return p


def session(cfg: Config) -> SparkSession:
    """A session whose driver and executors are held to the memory limit, where it is this that starts them."""
    conf = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.driver.memory": cfg.spark_memory(), "spark.executor.memory": cfg.spark_memory()}
    return SparkSession.builder.appName("larkspur").config(map=conf).getOrCreate()


def main(argv: list[str] | None = None) -> None:
    args = vars(parser().parse_args(argv))
    command, path = args.pop("command"), args.pop("config")
    cfg = Config.load(path, **args).dated()
    spark = session(cfg)
    if command == "build":
        snapshot.build(spark, cfg)
        return
    run = {
        "mirror": snapshot.mirror, "stage": snapshot.stage, "hydrate": snapshot.hydrate, "upload": snapshot.upload, "inspect": lambda s, c: snapshot.inspect(s, c.mirror_dir),
        "report": lambda s, c: {r.name: r.n for r in staging.report(kv.read(s, c.mirror_dir)).collect()},
    }[command]
    print(json.dumps(run(spark, cfg)))


if __name__ == "__main__":
    main()
