"""Command line: python -m loomdoc STAGE ..., each stage from table to table (parquet)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import select as X
from .plans import engine
from .sources import files
from .sources.stage import staged

#: Weights of the five signals and thresholds.
_CONFIG = ("k", "e", "c", "t", "p", "ambiguity", "fallback", "temperature", "min_tokens", "topk", "max_domains")


def config(a) -> X.Config:
    """The selector's settings from the command line."""
    return X.Config(**{k: getattr(a, k) for k in _CONFIG})


def stages(spark: SparkSession) -> dict:
    read = spark.read.parquet

    def parse(a):
        paths = files.expand_inputs(spark, a.inputs)
        files.structured(staged(files.parse(files.binary_files(spark, paths)), "parsed")).write.mode("overwrite").parquet(a.out)

    def contextize(a):
        topics, context = engine.contextize(read(a.inputs[0]).where("text IS NOT NULL"), a.top_k, a.eps, not a.light, a.min_samples)
        topics.write.mode("overwrite").parquet(f"{a.out}/topics")
        context.write.mode("overwrite").parquet(f"{a.out}/context")

    def chunk(a):
        engine.chunk(read(a.inputs[0]).where("text IS NOT NULL"), a.max_tokens, a.max_chars).write.mode("overwrite").parquet(a.out)

    def contextize_chunks(a):
        engine.contextize_chunks(read(a.inputs[0]), read(f"{a.inputs[1]}/topics"), read(f"{a.inputs[1]}/context")).write.mode("overwrite").parquet(a.out)

    def select(a):
        chunks = read(a.inputs[0])
        found = staged(engine.select(chunks, read(f"{a.inputs[1]}/context"), read(f"{a.inputs[1]}/topics"), config=config(a)), "selected")
        found.write.mode("overwrite").parquet(f"{a.out}/documents")
        engine.select_chunks(chunks, found, config=config(a)).write.mode("overwrite").parquet(f"{a.out}/chunks")

    return {"parse": parse, "contextize-doc": contextize, "chunk": chunk, "contextize-chunks": contextize_chunks, "schema-select": select}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomdoc", description=__doc__)
    sub = p.add_subparsers(dest="stage", required=True)
    for name in ("parse", "contextize-doc", "chunk", "contextize-chunks", "schema-select"):
        s = sub.add_parser(name)
        s.add_argument("inputs", nargs="+", help="paths or patterns (parse); table, and the folder of contextize-doc where needed")
        s.add_argument("--out", required=True)
        s.add_argument("--top-k", type=int, default=10)
        s.add_argument("--eps", type=float, default=0.25)
        s.add_argument("--light", action="store_true")
        s.add_argument("--max-tokens", type=int, default=2048)
        s.add_argument("--max-chars", type=int, default=9000)
        s.add_argument("--min-samples", type=int, default=2)
        for k in _CONFIG:
            s.add_argument(f"--{k.replace('_', '-')}", type=type(getattr(X.Config(), k)), default=getattr(X.Config(), k), help="of schema-select")
    s = sub.add_parser("pipeline-yaml", help="stages in the order of a YAML file: stages: [{name, args}]")
    s.add_argument("file")
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("loomdoc").getOrCreate()
    known = stages(spark)
    if a.stage != "pipeline-yaml":
        known[a.stage](a)
        return
    import yaml

    with open(a.file) as f:
        for stage in yaml.safe_load(f)["stages"]:
            told = stage.get("args", {})
            line = [stage["name"], *map(str, told.get("inputs", [])), "--out", str(told["out"])]
            line += [x for k, v in told.items() if k not in ("inputs", "out") for x in ([f"--{k.replace('_', '-')}"] if v is True else [f"--{k.replace('_', '-')}", str(v)])]
            known[stage["name"]](parser().parse_args(line))


if __name__ == "__main__":
    main()
