"""``python -m shelfmark etl|train|predict|profile``; see ``--help``."""

from __future__ import annotations

import argparse
import json

from shelfmark.plans import jobs
from shelfmark.session import get_spark
from shelfmark.sources.readers import dealt, read_jsonl
from shelfmark.sources.writers import write_parquet


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="shelfmark")
    commands = top.add_subparsers(dest="command", required=True)
    etl = commands.add_parser("etl", help="JSON-lines to combined text or token arrays")
    etl.add_argument("config", help="YAML file")
    train = commands.add_parser("train", help="train, evaluate and store a classifier")
    train.add_argument("--config", required=True, help="YAML file")
    train.add_argument("--data_fraction", type=float)
    train.add_argument("--input_data_path")
    train.add_argument("--model_path")
    predict = commands.add_parser("predict", help="score JSON-lines with a stored classifier")
    predict.add_argument("--model_path", required=True)
    predict.add_argument("--output_path", required=True)
    predict.add_argument("--rejected_path", help="records that do not conform to the declaration")
    profile = commands.add_parser("profile", help="category and word counts of JSON-lines")
    profile.add_argument("--output_path", required=True, help="a folder for the five tables")
    profile.add_argument("--category", default="main_cat")
    profile.add_argument("--text", default="description")
    for command in (predict, profile):
        command.add_argument("--input_path", required=True)
        command.add_argument("--schema", help="DDL; else a first pass infers the types")
        command.add_argument("--data_fraction", type=float, default=1.0)
        command.add_argument("--seed", type=int, default=42)
        command.add_argument("--key", help="column that decides the sample")
        command.add_argument("--partitions", type=int, help="deal the rows of a few gzip files out")
    return top


def main(argv: list[str] | None = None) -> None:
    options = vars(parser().parse_args(argv))
    command, spark = options.pop("command"), get_spark()
    if command == "etl":
        jobs.run_etl(spark, options["config"])
    elif command == "train":
        config = options.pop("config")
        given = {name: value for name, value in options.items() if value is not None}
        result = jobs.run_train(spark, config, **given)
        for row in result.metrics.collect():
            print(json.dumps(row.asDict()))
    else:
        records = read_jsonl(
            spark,
            options["input_path"],
            options["data_fraction"],
            options["seed"],
            options["schema"],
            options["key"],
        )
        records = dealt(records, options["partitions"])
        if command == "predict":
            scored = jobs.run_predict(spark, options["model_path"], records)
            write_parquet(scored, options["output_path"])
            if options["rejected_path"]:
                rejected = jobs.rejected_records(spark, options["model_path"], records)
                write_parquet(rejected, options["rejected_path"])
        else:
            tables = jobs.run_profile(records, options["category"], options["text"])
            for name, table in tables.items():
                write_parquet(table, f"{options['output_path']}/{name}")


if __name__ == "__main__":
    main()
