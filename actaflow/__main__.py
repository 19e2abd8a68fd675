"""Command line: ``python -m actaflow COMMAND``.

extract      acts of a Markdown lake into the act table
listing      editions of saved portal answers
dedup        maintenance deduplication of yearly act tables, with a report
analyse      timelines, returns, summaries and rejected names, whole or incremental
consolidate  movements and returns by state
report       top representatives as a Markdown table, put between markers of a file
"""

from __future__ import annotations

import argparse
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actaflow import schemas as S
from actaflow.operators import analytics, consolidate, repair, timeline
from actaflow.operators.dedup import complete_columns
from actaflow.plans.extract import extract_acts
from actaflow.runtime import cut
from actaflow.sources import lake, portals


def _acts(spark: SparkSession, path: str, state: str | None, years: tuple[int, ...]) -> DataFrame:
    """Acts below ``path``: CSV files by state, or the Parquet act table."""
    if os.path.exists(path) and not lake.csv_files(spark, path).limit(1).count():
        rows = spark.read.parquet(path).withColumn("linha_csv", F.monotonically_increasing_id())
        rows = rows.where(F.col("estado") == state) if state else rows
        return rows.where(F.substring("data_publicacao", 1, 4).isin(*map(str, years))) if years else rows
    rows = lake.read_acts_csv(spark, path, state, years)
    return rows.withColumn("linha_csv", F.xxhash64("arquivo_csv", "linha_csv"))


def extract(spark: SparkSession, a: argparse.Namespace) -> int:
    docs = lake.lake_documents(spark, a.lake, a.first, a.last).withColumn("doc_id", F.xxhash64("path"))
    found = extract_acts(docs).join(docs.select("doc_id", "path", "caderno", F.col("data_publicacao").cast("string").alias("data_publicacao")), "doc_id")
    acts = found.withColumn("arquivo_markdown", F.col("path")).withColumn("governador_edicao", F.lit(""))
    acts = complete_columns(acts, S.ACT_COLUMNS)
    acts = repair.with_governor(acts, repair.edition_governor(docs, list(S.ORIGINS)))
    return lake.write_acts(acts, a.output)


def listing(spark: SparkSession, a: argparse.Namespace) -> int:
    spark.dataSource.register(portals.PortalSource)
    rows = spark.read.format("gazette_portal").option("path", a.answers).option("base", a.base).load()
    rows.write.mode("overwrite").parquet(a.output)
    return spark.read.parquet(a.output).count()


def dedup(spark: SparkSession, a: argparse.Namespace) -> int:
    report = lake.deduplicate_files(spark, a.input, a.state, a.chars, a.dry_run)
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(a.report)
    return lake.dedup_totals(report).first().duplicatas_removidas or 0


def analyse(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = consolidate.recognised(_acts(spark, a.input, a.state, tuple(a.year)), a.recognition)
    people = timeline.person_acts(rows.where("motivo_rejeicao = ''") if "motivo_rejeicao" in rows.columns else rows)
    people = people.where(timeline.in_range(F.col("data"), a.first, a.last)) if a.first or a.last else people
    out = f"{a.output}/{a.state}" if a.state and not a.output.rstrip("/").endswith(f"/{a.state}") else a.output
    whole = timeline.affected_timeline(spark.read.parquet(f"{out}/atos").select(*people.columns), people) if a.incremental else timeline.timeline(people)
    if a.milestone:
        whole = timeline.latest_milestone(whole, [tuple(m.partition(":")[::2]) if ":" in m else (m, m) for m in a.milestone])
    whole = cut(whole, "timeline")
    base = whole.select(*people.columns)
    base.write.mode("overwrite").parquet(f"{out}/atos")
    whole.write.mode("overwrite").parquet(f"{out}/movimentacoes_pessoas")
    whole.where("retorno").write.mode("overwrite").parquet(f"{out}/retornos")
    timeline.person_summary(whole).orderBy("nome_normalizado").write.mode("overwrite").parquet(f"{out}/resumo_pessoas")
    timeline.rejected_names(rows).write.mode("overwrite").parquet(f"{out}/nomes_rejeitados")
    return whole.count()


def consolidated(spark: SparkSession, a: argparse.Namespace) -> int:
    whole = spark.read.parquet(f"{a.input}/movimentacoes_pessoas")
    consolidate.write_partitioned(consolidate.movements(whole), f"{a.output}/movimentacoes")
    consolidate.write_partitioned(consolidate.returns(whole), f"{a.output}/retornos")
    return spark.read.parquet(f"{a.output}/movimentacoes").count()


def load_state(spark: SparkSession, path: str, state: str) -> tuple[DataFrame, DataFrame]:
    """Movements and returns of one state; an error if either table lacks it."""
    both = [spark.read.parquet(f"{path}/{t}") for t in ("movimentacoes", "retornos")]
    if consolidate.states_with_both(*both).where(F.col("estado") == state).isEmpty():
        raise FileNotFoundError(f"no consolidated data of {state}")
    return tuple(t.where(F.col("estado") == state) for t in both)


def available_states(spark: SparkSession, path: str) -> list[str]:
    """States with both tables (at most 27)."""
    both = [spark.read.parquet(f"{path}/{t}") for t in ("movimentacoes", "retornos")]
    return sorted(r.estado for r in consolidate.states_with_both(*both).collect())


BEGIN, END = "<!-- {0}:begin -->", "<!-- {0}:end -->"


def put_block(text: str, name: str, block: str) -> str:
    """``text`` with what stands between the markers of ``name`` replaced; markers that are missing are added at the end."""
    a, b = BEGIN.format(name), END.format(name)
    if a not in text:
        return f"{text.rstrip()}\n\n{a}\n{block}\n{b}\n"
    return re.sub(rf"{re.escape(a)}.*?{re.escape(b)}", lambda m: f"{a}\n{block}\n{b}", text, flags=re.S)


def report(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = spark.read.parquet(f"{a.input}/movimentacoes")
    rows = rows.where(F.col("estado") == a.state) if a.state else rows
    top = analytics.balance(rows, "representante_origem").orderBy(F.desc("atos"), "representante_origem").limit(5)
    cells = top.select("representante_origem", *[repair.thousands(F.col(c)).alias(c) for c in ("nomeacao", "exoneracao", "saldo")]).collect()  # five rows
    table = "\n".join(["| Representante | Nomeações | Exonerações | Saldo |", "|---|---|---|---|", *(f"| {' | '.join(r)} |" for r in cells)])
    text = open(a.file, encoding="utf-8").read() if os.path.exists(a.file) else ""
    with open(a.file, "w", encoding="utf-8") as f:
        f.write(put_block(text, a.block, table))
    return len(cells)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="actaflow", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name, run, *args):
        c = sub.add_parser(name)
        for flags, options in args:
            c.add_argument(*flags, **options)
        c.set_defaults(run=run)

    out, state = (["--output"], {"required": True}), (["--state"], {})
    days = (["--first"], {}), (["--last"], {})
    command("extract", extract, (["--lake"], {"required": True}), out, *days)
    command("listing", listing, (["--answers"], {"required": True}), (["--base"], {"default": ""}), out)
    command("dedup", dedup, (["--input"], {"required": True}), (["--report"], {"required": True}), state, (["--chars"], {"type": int, "default": 240}), (["--dry-run"], {"action": "store_true"}))
    command("analyse", analyse, (["--input"], {"required": True}), out, state, *days, (["--year"], {"type": int, "action": "append", "default": []}), (["--milestone"], {"action": "append", "default": []}),
            (["--recognition"], {"choices": ("marcar", "filtrar", "filter"), "default": "marcar"}), (["--incremental"], {"action": "store_true"}))
    command("consolidate", consolidated, (["--input"], {"required": True}), out)
    command("report", report, (["--input"], {"required": True}), (["--file"], {"required": True}), (["--block"], {"default": "top"}), state)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    session = spark or SparkSession.builder.appName("actaflow").getOrCreate()
    n = a.run(session, a)
    print(f"{a.command}: {n}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
