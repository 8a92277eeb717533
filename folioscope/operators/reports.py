"""Reports of the two stages: a JSON document with fixed keys and its Markdown."""

from __future__ import annotations

import json
import os
import time

from . import images, stats


def _write(folder: str, name: str, lines: list[str], document: dict) -> dict:
    os.makedirs(folder, exist_ok=True)
    for suffix, body in ((".md", "\n".join(lines) + "\n"), (".md.json" if name == "REPORT" else ".json", json.dumps(document, indent=2, default=str))):
        with open(os.path.join(folder, name + suffix), "w", encoding="utf-8") as file:
            file.write(body)
    return document


def build_report(out: str, build, violations: list[dict], smoke: list[dict], wall_seconds: float, max_edge: int = 4096) -> dict:
    """First stage: counters, gate results and every dropped item."""
    counted = stats.counters(build)
    bad = [r.asDict() for r in build.bad_items.collect()]
    failed = [r.asDict() for r in build.failed.collect()]
    document = {k: v for k, v in counted.items() if k != "gif_flattened_failed"} | {
        "hard_gate": not violations,
        "hard_gate_violations": violations,
        "smoke_test": not smoke,
        "smoke_msg": "ok" if not smoke else smoke[0]["message"],
        "max_image_edge": max_edge,
        "png_compresslevel": images.PNG_LEVEL,
        "wall_seconds": round(wall_seconds, 2),
        "out": out,
    }
    lines = ["# Article table", "", "## Numbers", *(f"- {k}: {v}" for k, v in counted.items() if not isinstance(v, dict))]
    lines += [f"- images per article: {{{stats.compact_histogram(counted['histogram'])}}}", "", "## Flagged contents", *(f"- {k}: {v}" for k, v in counted["warn_empty_content"].items())]
    lines += ["", "## Gates", f"- rules on all rows: {'FAIL' if violations else 'PASS'}", *(f"  - {v}" for v in violations), f"- rules on the first rows: {'FAIL' if smoke else 'PASS'}"]
    lines += ["", "## Dropped items", *(f"- {b['id']} ref={b['ref']} resolved={b['resolved']} error={b['error']}" for b in bad)]
    lines += ["", "## Unreadable articles", *(f"- {f['article']}: {f['error']}" for f in failed)]
    return _write(out, "REPORT", lines, document)


def index_report(out: str, stem: str, dataset: str, verification: dict, loop_stats: dict, retrieval: dict, modality: str = "image_text", multi_image: str = "primary", env: dict | None = None, command: list[str] | None = None) -> dict:
    """Second stage: gate, index and retrieval results."""
    result = "PASS" if retrieval["passed"] else "FAIL"
    document = {
        "generated_utc": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()),
        "dataset": dataset,
        "embed_file": loop_stats["embed_file"],
        "num_rows": loop_stats["num_rows"],
        "dim": loop_stats["dim"],
        "dtype": loop_stats["dtype"],
        "modality": modality,
        "multi_image": multi_image,
        "verification": verification,
        "loop_stats": loop_stats,
        "retrieval": retrieval,
        "env": env or {},
        "command": command or [],
        "result": result,
    }
    lines = [f"# Index {stem}", "", "## Table", *(f"- {k}: {v}" for k, v in verification.items() if not isinstance(v, list)), *(f"  - WARN {w}" for w in verification["warnings"][:10])]
    lines += ["", "## Index", *(f"- {k}: {v}" for k, v in loop_stats.items()), "", "## Retrieval", f"- in-domain {retrieval['in_domain_top1']}, out-of-domain {retrieval['out_of_domain_top1']} (lower is required)"]
    lines += [f"- {p['kind']}: {p['query']!r} -> " + ", ".join(f"#{r['rank']} {r['id']} ({r['score']})" for r in p["top5"]) for p in retrieval["probes"]]
    lines += ["", f"## Result: {result}", *retrieval["fail_reasons"]]
    return _write(out, f"REPORT_{stem}", lines, document)
