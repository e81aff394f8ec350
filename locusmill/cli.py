"""Command line: one subcommand a step. ``python -m locusmill.cli collapse --sample a=a.fq.gz --out collapsed``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from locusmill import steps
from locusmill.operators.loci import LocusRules
from locusmill.operators.origin import OriginRules
from locusmill.operators.peaks import PeakRules
from locusmill.operators.scoring import PAIRED

PREDICTORS = {PAIRED.name: PAIRED}


def _listed(text: str) -> list[str]:
    return [x for x in text.split(",") if x]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="locusmill", description="Small-RNA loci and their targets on Spark.")
    sub = p.add_subparsers(dest="step", required=True)

    def step(name: str, help_: str, *folders: str) -> argparse.ArgumentParser:
        s = sub.add_parser(name, help=help_)
        for f in folders:
            s.add_argument(f"--{f}", required=True)
        s.add_argument("--out", required=name != "estimate")
        return s

    s = step("collapse", "distinct reads of all samples")
    s.add_argument("--sample", action="append", required=True, help="NAME=PATH; again for each file")
    for k, n in (("min", 18), ("max", 28)):
        s.add_argument(f"--{k}-length", type=int, default=n)
    s = step("build-ref", "one reference of all genomes", "spec")
    for k, n in (("min", 18), ("max", 28)):
        s.add_argument(f"--{k}-length", type=int, default=n)
    s = step("align", "placements of the reads", "collapsed", "reference")
    s.add_argument("--mismatches", type=int, default=1)
    s = [s, step("assign", "genome of origin of the reads", "collapsed", "reference")]
    for x in s:
        x.add_argument("--mode", default="best")
        x.add_argument("--evil-max-diff", type=int, default=0)
        x.add_argument("--max-hits", type=int, default=50)
    s = s[1]
    s.add_argument("--aligned", default=None)
    s.add_argument("--sam", default=None)
    s.add_argument("--excess", default=None)
    s.add_argument("--ambiguous", default="report")
    s.add_argument("--multimap", default="fractional")
    s.add_argument("--max-mismatches", type=int, default=None)
    s = step("discover", "loci of the placed reads", "collapsed", "reference", "assigned")
    s.add_argument("--merge-gap", type=int, default=0)
    s.add_argument("--no-peaks", action="store_true")
    for name, kind, default in (("min-count", float, 1.0), ("min-rpm", float, 5.0), ("min-samples", int, None), ("min-five-fraction", float, 0.5), ("min-three", float, 0.0), ("min-isolation", float, 0.5), ("five-filter", str, "dominant")):
        s.add_argument(f"--{name}", type=kind, default=default)
    step("coverage", "depth by position", "collapsed", "reference", "assigned")
    step("funnel", "reads left at each stage", "collapsed", "assigned", "discovered").add_argument("--trimming", nargs="*", default=[])
    s = step("regions", "target regions")
    for name in ("genome", "annotation", "transcripts", "table"):
        s.add_argument(f"--{name}", default="")
    s.add_argument("--regions", default="three_prime_UTR")
    s.add_argument("--whole-if-missing", action="store_true")
    s = step("decoys", "shuffled candidates", "candidates")
    s.add_argument("--n", type=int, default=20)
    s.add_argument("--seed", default="2-8")
    s.add_argument("--random-seed", type=int, default=1)
    for name, help_ in (("sites", "seed sites and their rates"), ("score-sites", "scored sites"), ("estimate", "what scoring would take")):
        s = step(name, help_, "candidates", "regions")
        s.add_argument("--decoys", default="")
        s.add_argument("--genomes", default="")
        s.add_argument("--seed", default="2-8")
        s.add_argument("--classes", default="")
        s.add_argument("--score-weak-sites", action="store_true")
        s.add_argument("--fdr", type=float, default=0.05)
        s.add_argument("--predictors", default=PAIRED.name)
    s = step("precursors", "folded surroundings of loci", "reference", "discovered")
    s.add_argument("--candidates", default="")
    s.add_argument("--anchor", default="representative")
    s.add_argument("--flanks", type=int, nargs="*", default=[15, 50])
    s.add_argument("--shuffles", type=int, default=1000)
    s.add_argument("--random-seed", type=int, default=1)
    s = step("evaluate", "results against planted features", "truth", "collapsed", "reference", "assigned", "discovered")
    s.add_argument("--settings", nargs="*", default=[], help="files with the run's settings, the first that exists counts")
    return p


def run(spark: SparkSession, argv: list[str]) -> list[str]:
    """Run one step; what it has to tell besides its tables."""
    a = parser().parse_args(argv)
    if a.step == "collapse":
        steps.collapse_reads(spark, a.sample, a.min_length, a.max_length, a.out)
    elif a.step == "build-ref":
        steps.build_reference(spark, json.loads(a.spec), a.min_length, a.max_length, a.out)
    elif a.step == "align":
        steps.align_reads(spark, a.collapsed, a.reference, a.mismatches, a.max_hits, a.out, a.mode, a.evil_max_diff)
    elif a.step == "assign":
        rules = OriginRules(a.ambiguous, a.multimap, a.mode, a.evil_max_diff, a.max_hits, a.max_mismatches)
        steps.assign_origin(spark, a.collapsed, a.reference, a.out, rules, a.aligned, a.sam, a.excess)
    elif a.step == "discover":
        rules = LocusRules(min_count=a.min_count, min_rpm=a.min_rpm, min_samples=a.min_samples, five_filter=a.five_filter, five=a.min_five_fraction, three=a.min_three, isolation=a.min_isolation)
        steps.discover(spark, a.collapsed, a.reference, a.assigned, a.out, rules, None if a.no_peaks else PeakRules(), a.merge_gap)
    elif a.step == "coverage":
        steps.coverage(spark, a.collapsed, a.reference, a.assigned, a.out)
    elif a.step == "funnel":
        steps.funnel(spark, a.trimming, a.collapsed, a.assigned, a.discovered, a.out)
    elif a.step == "regions":
        steps.target_regions(spark, a.out, _listed(a.regions), a.genome, a.annotation, a.transcripts, a.table, a.whole_if_missing)
    elif a.step == "decoys":
        steps.make_decoys(spark, a.candidates, a.n, a.out, a.seed, a.random_seed)
    elif a.step == "sites":
        steps.seed_sites(spark, a.candidates, a.regions, a.out, a.decoys, _listed(a.genomes), a.seed, _listed(a.classes))
    elif a.step == "score-sites":
        strange = [x for x in _listed(a.predictors) if x not in PREDICTORS]
        if strange:
            raise ValueError(f"unknown predictors: {', '.join(strange)}")
        steps.score_sites(spark, a.candidates, a.regions, a.decoys, a.out, [PREDICTORS[x] for x in _listed(a.predictors)], _listed(a.genomes), a.seed, _listed(a.classes), a.score_weak_sites, a.fdr)
    elif a.step == "estimate":
        classes, cost = steps.estimate(spark, a.candidates, a.regions, a.decoys, a.seed, _listed(a.classes), a.score_weak_sites)
        return [*(f"{r['site_class']}: {r['real_sites']} real, {r['decoy_sites']} decoy sites{'' if r['scored'] else ', not scored'}" for r in classes.collect()), *(f"{r['sites']} sites, {r['kb']:.1f} kb, about {r['core_hours']:.2f} core-hours" for r in cost.collect())]
    elif a.step == "precursors":
        unknown = steps.fold_precursors(spark, a.reference, a.discovered, a.out, a.candidates, a.anchor, tuple(a.flanks), a.shuffles, a.random_seed)
        return [f"candidates that no locus has are left out: {', '.join(unknown)}"] if unknown else []
    elif a.step == "evaluate":
        found = steps.settings.run_settings(a.settings)
        steps.evaluate(spark, a.truth, {k: getattr(a, k) for k in ("collapsed", "reference", "assigned", "discovered")}, a.out, found["mode"], found["evil_max_diff"])
        return [f"settings from {found['source']}"]
    return []


def main(argv: list[str] | None = None) -> None:
    spark = SparkSession.builder.appName("locusmill").getOrCreate()
    try:
        for line in run(spark, sys.argv[1:] if argv is None else argv):
            print(line)
    except ValueError as wrong:
        sys.exit(f"locusmill: {wrong}")


if __name__ == "__main__":
    main()
