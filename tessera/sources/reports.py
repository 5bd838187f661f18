"""Report files: JSON and Markdown of checks, and the acceptance sheet that reads them back."""

from __future__ import annotations

import json
from pathlib import Path

#: What a check's family is told by, in its name.
FAMILIES = ("recomputed", "integral", "counts", "quantiles", "codes", "shares", "distances", "range", "level means", "mask", "coverage")


def families(names: list[str]) -> list[str]:
    return [f for f in FAMILIES if any(f in n for n in names)] + (["other"] if any(not any(f in n for f in FAMILIES) for n in names) else [])


def write(stem: str, checks: list[dict], folder: str) -> bool:
    """``stem``.json and .md in ``folder``, the same for the same checks; True if none failed."""
    ok = all(x["status"] != "FAIL" for x in checks)
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    rows = [{k: x[k] for k in ("name", "status", "summary")} for x in checks]
    (out / f"{stem}.json").write_text(json.dumps({"verdict": "pass" if ok else "FAIL", "checks": rows}, indent=1, sort_keys=True))
    cell = lambda x: str(x).replace("|", "\\|").replace("\n", " ")
    lines = [f"# {stem}", "", f"Verdict: {'pass' if ok else 'FAIL'}", "", "| check | status | summary |", "|-|-|-|", *[f"| {cell(x['name'])} | {x['status']} | {cell(x['summary'])} |" for x in rows]]
    (out / f"{stem}.md").write_text("\n".join(lines) + "\n")
    return ok


def integrate(structure: list[dict], store: str, folder: str) -> bool:
    """Write ``integration``: the structure's checks and a row for each built layer's report. A missing or failed report fails, a stale one is named."""
    manifest = Path(store, "manifest.json")
    rows = [*structure]
    for x in json.loads(manifest.read_text())["layers"]:
        path, name = Path(folder, f"fidelity-{x['id']}.json"), f"{x['id']} fidelity"
        if not path.exists():
            rows.append({"name": name, "status": "FAIL", "summary": "no report"})
            continue
        try:
            report = json.loads(path.read_text())
            summary = f"{len(report['checks'])} checks: {', '.join(families([c['name'] for c in report['checks']]))}"
            rows.append({"name": name, "status": "pass" if report["verdict"] == "pass" else "FAIL", "summary": summary})
        except (ValueError, KeyError) as e:
            rows.append({"name": name, "status": "FAIL", "summary": f"unreadable report: {e!r}"})
        if path.stat().st_mtime < manifest.stat().st_mtime:
            rows.append({"name": f"{name} age", "status": "report", "summary": "older than the manifest"})
    return write("integration", rows, folder)
