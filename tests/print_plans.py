"""Write PLANS.md: the physical plans of the day jobs, from `explain`.

    python tests/print_plans.py [sf_dir]

Lands the raw log and IP library of a scale factor as text in a scratch
folder, builds each job's DataFrame the way the job does, and records the
physical plan tree (operators and scan schemas).
"""

from __future__ import annotations

import contextlib
import io as _io
import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from accesslake.operators import ads, dwd, ods  # noqa: E402
from accesslake.plans import ods_job  # noqa: E402
from accesslake.schemas import DWD_SCHEMA, ODS_SCHEMA  # noqa: E402
from accesslake.session import local_session  # noqa: E402
from accesslake.sources import fixtures, io  # noqa: E402

NOTES = {
    "ODS job": "Map-only: one stage, no exchange. The reject rule is a filter in the same "
    "codegen stage; counts ride along in the write (Observation). At 100 TB: one task per "
    "input split, one file per task (capped by maxRecordsPerFile).",
    "DWD job, IP library within the broadcast budget": "The IP library is checked exactly, "
    "then broadcast: the ODS side is never shuffled, so its ip skew cannot hurt. The ODS scan "
    "reads only the day's folder.",
    "DWD job, IP library too big to broadcast": "Sort-merge join on (ip, _salt): both sides are "
    "shuffled once. The salt count of each hot ip (sampled; all that hold four times a reducer's share) is attached by "
    "a broadcast join with a small (ip, _nsalts) table, so a row pays one hash probe. Hot ips "
    "get ~share x partitions salts, their library rows are replicated per salt (Generate "
    "explode), and NULL ips spread over all partitions.",
    "DWD job, V1 lookup (one row per ip, '-' on a miss)": "The library is deduplicated by a "
    "partial + final aggregate (sort-based: a maximum over strings), then broadcast after the "
    "size check.",
    "ADS job": "Reads only city and host of one day; partial aggregate before the exchange, "
    "so a hot (city, host) sends one row per task.",
    "ADS preview (top 55)": "TakeOrderedAndProject: per-task top-n, merged once; no full sort.",
}


def _tree(df) -> str:
    """The final AQE plan (after running the frame): operators with their
    codegen stage `*(n)`, long expressions cut, plus the scan schemas."""
    df.collect()
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    final = text.split("+- == Initial Plan ==")[0]
    lines = []
    for line in final.splitlines():
        if not line.strip() or line.startswith("== Physical Plan =="):
            continue
        line = re.sub(r"#\d+L?", "", line)
        lines.append(line if len(line) <= 110 else line[:107] + "...")
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    schemas = re.findall(r"^ReadSchema: (.*)$", buf.getvalue(), flags=re.M)
    return "\n".join(lines + [f"ReadSchema: {x}" for x in dict.fromkeys(schemas)])


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    base = io.scratch_dir(spark, "plans")
    raw, ip, ods_root, dwd_root = (f"{base}/{x}" for x in ("raw", "ip", "ods", "dwd"))
    d = "20240101"
    io.write_text(fixtures.raw_access(spark, sf), raw, compression=None)
    io.write_text(fixtures.ip_lines(spark, sf), ip, compression=None)
    ods_job(spark, raw, ods_root, d)
    pre = dwd.widen(io.read_day(spark, ods_root, ODS_SCHEMA, d).drop("d"))
    dim = dwd.ip_dim(io.read_lines(spark, ip))
    wide = dwd.enrich(pre, dim)
    io.write_day(wide, dwd_root, d)
    day = io.read_day(spark, dwd_root, DWD_SCHEMA, d)
    frames = {
        "ODS job": ods.good(ods.tag(io.read_lines(spark, raw))),
        "DWD job, IP library within the broadcast budget": wide,
        "DWD job, IP library too big to broadcast": dwd.enrich(pre, dim, max_broadcast_rows=0, hot_share=0.002),
        "DWD job, V1 lookup (one row per ip, '-' on a miss)": dwd.enrich_lookup(pre, dim),
        "ADS job": ads.area_traffic(day),
        "ADS preview (top 55)": ads.preview(ads.area_traffic(day), 55),
    }
    out = [
        "# Physical plans of the day jobs",
        "",
        f"Generated by `python tests/print_plans.py {sf}` (local[8], AQE on; paths shortened).",
        "Plans are the final AQE plans after running each frame: `*(n)` marks a whole-stage",
        "codegen stage; `ShuffleQueryStage`/`BroadcastQueryStage` are AQE's stage boundaries.",
        "",
    ]
    for name, df in frames.items():
        tree = re.sub(r"file:[^\s,\]]*/plans-[0-9a-f]+", "<scratch>", _tree(df))
        tree = re.sub(r"\[plan_id=\d+\]", "", tree)
        out += [f"## {name}", "", NOTES[name], "", "```", tree, "```", ""]
    Path(ROOT / "PLANS.md").write_text("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
