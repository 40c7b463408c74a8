"""Command line: ``python -m genoweave STAGE ...``. Paths may be on any file system that Spark reaches."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from genoweave import session
from genoweave.operators import peaks, vocab, windows
from genoweave.plans import build, migrate, release
from genoweave.sources import readers, sinks


def main(args: list[str] | None = None) -> int:
    top = argparse.ArgumentParser("genoweave", description=__doc__)
    stages = top.add_subparsers(dest="stage", required=True)

    p = stages.add_parser("tracks", help="peaks and experiments to groups and maximum-score tracks")
    for name in ("--meta", "--peaks", "--org", "--out"):
        p.add_argument(name, required=True)
    p.add_argument("--source", default="auto")
    p.add_argument("--group-by", nargs="+", default=list(peaks.GROUP_BY))
    p.add_argument("--bin-size", type=int, default=1)
    p.add_argument("--beds", action="store_true", help="write each group's peaks as BED text too")

    p = stages.add_parser("release", help="tracks to a verified release")
    for name in ("--tracks", "--root", "--org", "--id", "--fasta", "--blacklist"):
        p.add_argument(name, required=True)
    p.add_argument("--windows", type=int, nargs="+", default=list(windows.WINDOWS))
    p.add_argument("--keep-chroms", nargs="+")
    p.add_argument("--class-list")
    p.add_argument("--min-antigens", type=int, default=vocab.MIN_ANTIGENS)
    p.add_argument("--min-tissues", type=int, default=vocab.MIN_TISSUES)

    p.add_argument("--donor", help="a tree chrom/start_end.txt of sequence chunks to adopt")

    p = stages.add_parser("report", help="counts that the tracks' build took, and an audit of the stored files")
    p.add_argument("--out", required=True, help="what the tracks stage wrote")
    for stage in ("promote", "list", "verify"):
        p = stages.add_parser(stage)
        p.add_argument("--root", required=True)
        p.add_argument("--org", required=True)
        if stage != "list":
            p.add_argument("--id", required=True)
    p = stages.add_parser("migrate", help="move a legacy tree into a release; shows the plan unless --execute")
    for name in ("--legacy", "--root", "--org", "--id", "--class-list"):
        p.add_argument(name, required=True)
    p.add_argument("--execute", action="store_true")
    a = top.parse_args(args)

    spark = session.with_checkpoints(session.build(f"genoweave-{a.stage}"))
    if a.stage == "tracks":
        rows = readers.read_peaks(spark, a.peaks)
        experiments = readers.read_experiment_list(spark, a.meta, a.source)
        counts = build.PeakCounts()
        groups, resolved, runs = build.build_tracks(rows, experiments, a.org, group_by=a.group_by, bin_size=a.bin_size, counts=counts)
        groups.coalesce(1).write.mode("overwrite").parquet(f"{a.out}/groups")
        sinks.write_tracks(runs, f"{a.out}/tracks", a.group_by)
        found = counts.result()
        sinks.put_text(spark, f"{a.out}/counts.json", json.dumps(found, indent=1))
        if a.beds:
            sinks.write_group_beds(resolved.join(groups.select("group_id", *a.group_by), "group_id"), f"{a.out}/beds", a.group_by)
        return int(found["lost"] != 0)
    if a.stage == "report":
        return report(spark, a.out)
    if a.stage == "verify":
        return _said(build.verify_release(release.Release.open(spark, a.root, a.org, a.id)))
    if a.stage == "release":
        codes = vocab.class_codes(readers.read_class_list(spark, a.class_list)) if a.class_list else None
        made = release.Release.create(spark, a.root, a.org, a.id)
        counts = json.loads(sinks.get_text(spark, f"{a.tracks}/counts.json")) if readers._exists(spark, f"{a.tracks}/counts.json") else None
        checks = build.build_release(
            made, spark.read.parquet(f"{a.tracks}/groups"), readers.read_tracks(spark, f"{a.tracks}/tracks"), readers.Fasta(spark, a.fasta).pieces, readers.read_runs(spark, a.blacklist),
            sizes=a.windows, keep_chroms=a.keep_chroms, codes=codes, min_antigens=a.min_antigens, min_tissues=a.min_tissues, peak_counts=counts, donor=readers.read_dna_tree(spark, a.donor) if a.donor else None,
        )
        return _said(checks)
    elif a.stage == "promote":
        release.promote(spark, a.root, a.org, a.id)
    elif a.stage == "list":
        print(*release.list_releases(spark, a.root, a.org), sep="\n")
    else:
        codes = vocab.class_codes(readers.read_class_list(spark, a.class_list))
        if a.execute:
            done = migrate.migrate(spark, a.legacy, a.root, a.org, a.id, codes).manifest["stages"]["migrate"]
            print(f"{done['moved']} files moved, {done['left']} left in place")
        else:
            moves = migrate.plan(spark, a.legacy, a.root, a.org, a.id, codes)
            moves.orderBy("old").select("old", "new").show(20, False)
            moves.groupBy("kind").count().show()
    return 0


def _said(checks: list[tuple[str, int, bool]]) -> int:
    for name, faults, ok in checks:
        print("ok  " if ok else "FAIL", name, faults)
    return int(not all(ok for _, _, ok in checks))


def report(spark, out: str) -> int:
    """Prints the counts of a tracks build, the largest stored files, and rows out of order in them; 1 if peaks were lost or rows
    lie out of order."""
    counts = json.loads(sinks.get_text(spark, f"{out}/counts.json"))
    print(*[f"{k}: {v}" for k, v in counts.items()], sep="\n")
    late = 0
    for part, scan in (("tracks", lambda p: spark.read.parquet(p)), ("beds", lambda p: spark.read.schema(readers.PEAK).option("sep", "\t").csv(p))):
        if readers._exists(spark, f"{out}/{part}"):
            files = readers.stored_order(scan(f"{out}/{part}"))
            total = files.agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("out_of_order").alias("late")).first()
            late += total.late or 0
            print(f"{part}: {total.files} files, {total.rows} rows, {total.late} out of order")
            files.orderBy(F.desc("rows"), "path").show(8, False)
    return int(counts["lost"] != 0 or late > 0)


if __name__ == "__main__":
    raise SystemExit(main())
