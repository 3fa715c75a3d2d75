"""Command lines: python -m foliomend merge | fix | translate | figures."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomend.operators import figures as G
from foliomend.plans import fix, merge, translate
from foliomend.plans.config import default_config, load_config
from foliomend.sources import pages as R
from foliomend.sources import sinks


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="foliomend")
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("merge", help="page records and page files to documents, images and metadata")
    one.add_argument("records", help="JSON lines files, or a folder or pattern of them")
    one.add_argument("pages", help="folder of the page files")
    one.add_argument("-n", "--no-header-footer", action="store_true")
    one.add_argument("-p", "--page", action="store_true", help="a heading with its number before each page")
    one = commands.add_parser("fix", help="repair Markdown files")
    one.add_argument("input")
    one.add_argument("--rules", choices=["old", "new"], default="new")
    one.add_argument("--level", choices=["conservative", "moderate", "aggressive"], default="conservative")
    one = commands.add_parser("translate", help="translate Markdown files")
    one.add_argument("input")
    one.add_argument("-c", "--config", help="JSON, YAML or TOML file")
    one.add_argument("-s", "--source-lang")
    one.add_argument("-t", "--target-lang")
    one.add_argument("--answers", help="folder for the model's answers, which a run that is started again finds")
    one.add_argument("--calls", type=int, help="calls at a time, in all")
    one = commands.add_parser("figures", help="move figures to the head of their sections")
    one.add_argument("input")
    for command in commands.choices.values():
        command.add_argument("-o", "--output", default="output", help="folder that all machines reach")
    return parser


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, md) of the Markdown files below a path, and their names (doc_id, name) below it, no two the same."""
    files = R.read_files(spark, path).select(F.xxhash64("path").alias("doc_id"), "path", F.col("value").alias("md"))
    name = F.regexp_replace(R.relative(F.col("path"), R.roots(spark, path)), r"\.md\z", "")
    return files.select("doc_id", "md"), sinks.checked_names(files.select("doc_id", name.alias("name")))


def save(texts: DataFrame, names: DataFrame, ending: str, text_col: str, output: str) -> None:
    named = texts.join(names, "doc_id").select(F.concat("name", F.lit(ending)).alias("path"), F.col(text_col).alias("content"))
    sinks.write_files(named, output)


def main(given: list[str] | None = None) -> None:
    args = arguments().parse_args(given)
    spark = SparkSession.builder.appName("foliomend").getOrCreate()
    if args.command == "merge":
        merge.run(spark, args.records, args.pages, args.output, args.no_header_footer, args.page)
        return
    docs, names = read(spark, args.input)
    if args.command == "fix":
        save(fix.fix_new(docs) if args.rules == "new" else fix.fix_old(docs, args.level)[0], names, ".md", "md", args.output)
    elif args.command == "figures":
        save(G.moved(docs), names, ".md", "md", args.output)
    else:
        cfg, options = load_config(args.config) if args.config else (default_config(), {})
        cfg = cfg.with_languages(args.source_lang, args.target_lang)
        for ending, df, column in translate.outputs(*translate.translate(docs, cfg, translate.translator_for(cfg, options), kept=args.answers, calls=args.calls)):
            save(df, names, ending, column, args.output)


if __name__ == "__main__":
    main(sys.argv[1:])
