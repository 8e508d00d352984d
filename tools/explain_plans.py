"""Regenerate docs/PLANS.md: explain("formatted") of the headline operators.

    python tools/explain_plans.py /root/testdata/sf0.01 [docs/PLANS.md]
"""

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEAD = """# Physical plans

`explain("formatted")` of the headline operators on the written star store at sf0.01
(PySpark 4.1.2, AQE on, 16 shuffle partitions; regenerate with any session, the shapes
do not depend on scale except where a table crosses a broadcast bound).

What to look for, per plan:

* **Fact loads (L9-L11 + L1), a batch of one month.** The batch's months prune the
  existing fact (`PartitionFilters` on `mes`), of which the two key columns are read. The
  batch's keys are broadcast to them, and the hits to the batch: no exchange of the
  fact. In-batch dedup has found no repeated key in a hash aggregation of the key columns
  before, so no row of the batch is sorted or shuffled. The dimension lookups are
  broadcast hash joins, each behind the row count recorded when the dimension was written.
* **Update of a fact.** Only the partitions that a new or differing row touches are read
  as a whole (`PartitionFilters`) and overwritten.
* **markov_long (M3).** Map-side partial `HashAggregate` on (origin, destination),
  then an exchange of pre-aggregated pairs. The per-origin total is a window over
  that small aggregate, so a hot origin yard cannot concentrate raw movement
  rows in one task. Yard names join last, broadcast. The scan reads two bigint
  columns.
* **markov_matrix (M2).** The same pairs; the percentage of each cell is computed once, and
  the pivot (`pivotfirst`) places it in an array by its column's position.
* **top_groups (R4).** One fact: the reservation's quantity is carried on the rental.
  A partial + final aggregation on (group, customer, source) surrogate keys comes first,
  so the customer dimension, a shuffle join at scale, meets aggregated rows.
  Then the report aggregation on the 7 keys. `RANK` runs on aggregated rows.
* **open_rentals (R2).** `situacao = aberta` prunes the fact to the files of open rentals.
* **reservation_demand (R3).** `mes >= ...` prunes the fact to the months to come; the date
  key's condition is pushed into their scan.
* **fleet_by_group (R1).** The fact is reduced to its (vehicle, group) pairs
  (two bigint columns) before any dimension is touched.
* **insert_ignore_new (L1 on lineitem).** Rows of keys that do not repeat pass through;
  those of repeated keys (a broadcast semi join) are reduced by `min_by`.
* **dq_unique, dq_source_unique (Q3).** One scan a table for all its keys, one exchange of
  counted (rule, key) pairs.
* **dq_fk (Q5).** Child foreign keys are aggregated per (source, key) before the
  anti join, so a parent referenced by a third of all rows is one row at the
  join.

"""

HEADLINE = ["markov_long", "markov_matrix", "top_groups", "open_rentals", "reservation_demand", "fleet_by_group",
            "insert_ignore_new", "dq_unique", "dq_fk"]
WIDE = 400  # plans of many columns are cut here
SCAN = re.compile(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?Location: [^\n]*/([a-z_]+)\]\n"
                  r"(?:PartitionFilters: ([^\n]*)\n)?(?:PushedFilters: ([^\n]*)\n)?ReadSchema: ([^\n]*)")


def section(title: str, df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n")[0].replace("== Physical Plan ==\n", "")
    tree = "\n".join(line[:WIDE] for line in tree.strip().split("\n"))
    out = [f"### {title}\n\n```\n{tree}\n```\n"]
    scans = SCAN.findall(text)
    if scans:
        out.append("| scan | partition filters | pushed filters | read schema |\n|---|---|---|---|")
        for row in scans:
            cells = [c if len(c) <= 150 else c[:150] + "…" for c in row]
            out.append(f"| {cells[0]} | {cells[1] or '–'} | {cells[2] or '–'} | `{cells[3]}` |")
        out.append("")
    return "\n".join(out)


def main(sf: str, target: str) -> None:
    from fleetdw.plans import fact_store as FS
    from fleetdw.plans import facts as FX
    from fleetdw.plans.star import FACT_SK, store_for
    from fleetdw.queries import registry
    from fleetdw.schemas import NATURAL_KEYS
    from fleetdw.session import build_session

    spark = build_session("local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    wh = store_for(spark, sf)
    q = registry()
    parts = []
    for name, (std_name, build) in FX.BUILDERS.items():
        day = FS.LAYOUTS[name].std_date
        batch = wh.table(std_name).where(f"{day} >= '1996-03-01' AND {day} < '1996-04-01'")  # a month's rows
        fact = FS.in_months(wh.table(name), FS.hit_months(name, batch))
        parts.append(section(f"{name} load of a month", build(batch, wh.dims(), fact, batch.count())))
    name, keys, sk = "fato_reserva", NATURAL_KEYS["fato_reserva"], FACT_SK["fato_reserva"]
    fact = wh.table(name)
    batch = fact.drop(sk).where("mes = 199603")
    parts.append(section(f"{name}: what a batch changes", FS.differing(name, fact, batch, keys, sk, 1, small=True)))
    parts += [section(n, q[n](spark, sf)) for n in HEADLINE]
    with open(target, "w") as f:
        f.write(HEAD + "\n".join(parts))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else "docs/PLANS.md")
