"""Command line: build, validate, fidelity, integrate, checksum, export-public. Exit code 0 pass, 1 fail, 2 contract or lookup error."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.plans import builders
from tessera.plans.builders import BUILDERS
from tessera.sources import contract as contracts
from tessera.sources import packaging, reports, store

def build(spark: SparkSession, contract_path: str, data: str, out: str) -> list[str]:
    """Write every layer that has a builder, then the manifest; gives the ids that wait for one. A broken contract writes nothing."""
    contract = contracts.load_contract(contract_path)
    broken = contracts.violations(contracts.frame(spark, contract)).collect()
    if broken:
        raise contracts.ContractViolation("; ".join(f"{x.id}: {x.rule}" for x in broken))
    ready = [x for x in contract.layers if x.id in BUILDERS]
    for layer in ready:
        for tier in layer.tiers:
            store.write_layer(BUILDERS[layer.id].make(spark, data, tier), out, layer.id, tier)
            if layer.needs_mask:
                store.write_mask(spark, out, layer.id, tier)
    if ready:
        cells = store.read_store(spark, out).where(~F.col("layer").endswith(store.MASK))
        cover = [x.asDict() for x in store.coverage(cells).collect()]
        store.write_manifest(store.manifest(contract, cover), out)
    return [x.id for x in contract.layers if x.id not in BUILDERS]


def fidelity(spark: SparkSession, layer: str, data: str, store_dir: str, folder: str) -> bool:
    """Check a layer against its source, write its report and say whether nothing failed."""
    entry = next((x for x in store.read_manifest(store_dir)["layers"] if x["id"] == layer), None)
    if entry is None or layer not in BUILDERS:
        raise KeyError(f"{layer} is not built")
    found = builders.checks(spark, layer, data, {t: store.read_layer(spark, store_dir, layer, t) for t in sorted(entry["coverage"])}).collect()
    return reports.write(f"fidelity-{layer}", [x.asDict() for x in found], folder)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessera")
    verbs = parser.add_subparsers(dest="verb", required=True)
    for verb, names in {"build": ("contract", "data", "store"), "validate": ("contract", "store"), "fidelity": ("data", "store", "layer", "reports"), "integrate": ("contract", "store", "reports"), "checksum": ("store",), "export-public": ("contract", "store", "licences", "out")}.items():
        sub = verbs.add_parser(verb)
        for name in names:
            sub.add_argument(f"--{name}", required=True)
        if verb == "export-public":
            sub.add_argument("--dry-run", action="store_true", help="say what the export will hold and weigh, write nothing")
    args = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("tessera").getOrCreate()
    try:
        if args.verb == "build":
            waiting = build(spark, args.contract, args.data, args.store)
            print(json.dumps({"waiting": waiting}))
        elif args.verb == "validate":
            found = store.checks(spark, args.store, contracts.load_contract(args.contract)).collect()
            for x in found:
                print(x.status, x.name, x.summary)
            return int(any(x.status == "FAIL" for x in found))
        elif args.verb == "fidelity":
            return int(not fidelity(spark, args.layer, args.data, args.store, args.reports))
        elif args.verb == "integrate":
            contract = contracts.load_contract(args.contract)
            structure = [x.asDict() for x in store.checks(spark, args.store, contract).collect()]
            return int(not reports.integrate(structure, args.store, args.reports))
        elif args.verb == "checksum":
            for x in store.checksums(spark, args.store).orderBy("layer", "tier").collect():
                print(x.layer, x.tier, x.cells, x.checksum)
        else:
            licences = spark.read.schema("source string, status string").json(args.licences)
            plan = store.strip_plan(contracts.frame(spark, contracts.load_contract(args.contract)), licences).collect()
            keep, reasons = [x.id for x in plan if x.keep], {x.id: x.reason for x in plan}
            if args.dry_run:
                print(json.dumps({"plan": reasons, "packaging": packaging.packaging(*packaging.estimate(spark, args.store, keep)["public"])}, sort_keys=True))
            else:
                store.export_public(spark, args.store, keep, args.out)
                print(json.dumps(reasons, sort_keys=True))
    except (contracts.ContractViolation, FileNotFoundError, KeyError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
