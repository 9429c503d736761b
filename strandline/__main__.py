"""``python -m strandline <command>``: catalog, store, import, align, compare, estimate, site, sync over a folder of tables."""

from __future__ import annotations

import argparse
import datetime

from strandline.operators import aligner, corpus
from strandline.plans import pipelines, queries
from strandline.session import get_spark
from strandline.sources import documents, reference
from strandline.tables import load


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="strandline", description=__doc__)
    s = p.add_subparsers(dest="command", required=True)

    def command(name: str, *options: str, data: bool = True) -> argparse.ArgumentParser:
        c = s.add_parser(name)
        if data:
            c.add_argument("data", help="folder of tables")
        for o in options:
            c.add_argument(o)
        return c

    command("catalog", "--pages", "--durations", "--feed", "--out", data=False)
    command("store", "--out")
    command("transcripts", "path", data=False)
    command("import", "path", data=False)
    command("align", "--out")
    command("compare")
    command("estimate", "--now").add_argument("--days", type=int)
    command("site", "--out")
    c = command("sync", "--out", "--now", "--before")
    c.add_argument("--days", type=int)
    c.add_argument("--limit", type=int)
    c.add_argument("--force", action="store_true")
    command("query", "name")
    a = p.parse_args(argv)
    if getattr(a, "days", None) is not None and not a.now:
        a.now = datetime.datetime.now(datetime.UTC).isoformat()

    spark = get_spark()
    t = lambda n: load(spark, a.data, n)
    if a.command == "catalog":
        pipelines.build_catalog(spark, a.out, a.pages, a.durations, a.feed).show()
    elif a.command == "store":
        reference.write_store(a.out, t("surah"), t("ayah"))
    elif a.command == "transcripts":
        documents.read_transcripts(spark, a.path).groupBy("model").count().show()
    elif a.command == "import":
        documents.import_manual(spark, a.path).show()
    elif a.command == "align":
        aligner.align(queries.segments(spark, a.data), corpus.build_corpus(t("ayah"))).write.mode("overwrite").parquet(a.out)
    elif a.command == "compare":
        for d in pipelines.compare(queries.timeline(spark, a.data), t("transcripts")):
            d.show(truncate=False)
    elif a.command == "estimate":
        catalog = queries.catalog(spark, a.data)
        if a.days is not None:
            from strandline.operators.rules import within_last_days

            catalog = within_last_days(catalog, a.now, a.days)
        for d in pipelines.estimate(catalog):
            d.show(truncate=False)
    elif a.command == "site":
        args = queries.catalog(spark, a.data), queries.takes(spark, a.data), queries.timeline(spark, a.data), t("ayah"), t("surah")
        pipelines.site(spark, *args, a.out).show()
    elif a.command == "sync":
        args = queries.catalog(spark, a.data), queries.takes(spark, a.data), queries.segments(spark, a.data), t("ayah")
        status = pipelines.run_sync(spark, *args, a.out, days=a.days, now=a.now, before=a.before, limit=a.limit, force=a.force)
        status.groupBy("status").count().show()
    elif a.command == "query":
        queries.R.queries[a.name](spark, a.data).show(50, False)


if __name__ == "__main__":
    main()
