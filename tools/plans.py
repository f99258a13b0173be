"""Print the physical plan trees of the headline queries (for PLANS.md).

Usage: python tools/plans.py [sf_dir] > PLANS.md
Only the operator tree of ``explain("formatted")`` is kept, plus the scans'
pushed filters and read schemas.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, ".")

from claimlens.operators import charges as ch  # noqa: E402
from claimlens.operators import classify as cl  # noqa: E402
from claimlens.operators import clustering as ck  # noqa: E402
from claimlens.operators import features as fe  # noqa: E402
from claimlens.operators import sampling as sa  # noqa: E402
from claimlens.operators.common import materialize  # noqa: E402
from claimlens.plans import registry  # noqa: E402
from claimlens.plans.q_part3 import features_of  # noqa: E402
from claimlens.session import get_session  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head, _, details = text.partition("\n\n\n")
    scans = []
    for block in details.split("\n\n"):
        if block.lstrip().startswith("(") and "Scan parquet" in block.splitlines()[0]:
            keep = [ln for ln in block.splitlines()
                    if ln.startswith(("(", "PushedFilters", "ReadSchema", "PartitionFilters"))]
            scans.append("\n".join(keep))
    head = re.sub(r"\[plan_id=\d+\]", "", head)
    return head.strip() + "\n\n" + "\n".join(scans)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session()
    charges = registry.charges_of(spark, sf)
    feats = materialize(features_of(spark, sf), "features")
    sample = materialize(sa.clustering_sample(feats, 150_000, 42), "sample")
    scored = spark.createDataFrame([("a", 1, 0.9, 0.9)], "patient_id string, review int, "
                                   "score double, p1 double")
    cents = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0)], "cluster int, idx int, value double")
    plans = {
        "part1a relative_variance": ch.relative_variance(charges, 3),
        "part1b most_top_charges": ch.most_top_charges(charges, 3),
        "part1c most_top_regions": ch.most_top_regions(charges, 3),
        "part2a provider_dispersion": ch.provider_dispersion(charges, 3),
        "patient_features": features_of(spark, sf),
        "clustering_sample (500 of the unflagged)": sa.clustering_sample(feats, 500, 42),
        "hash_features (vectors)": fe.hash_features(sample),
        "cosine_assign (long form)": ck.cosine_assign(fe.vector_long(sample), cents, 2),
        "assign_features (inside the row; 8 slots shown)": ck.assign_features(sample, cents, 2, 8),
        "vector_update (k vectors a task are exchanged)": ck.vector_update(ck.assign_features(
            fe.hash_features(sample, keep=tuple(sample.columns)), cents, 2, 8, ("features",))),
        "scoring_set (anti join)": sa.scoring_set(
            feats, spark.createDataFrame([("1", 0, 0)], "patient_id string, cluster int, label int"), 0),
        "suspicious_patients (top n)": cl.suspicious_patients(scored, 10_000),
        "score_features (inside the row; 8 slots shown)": cl.score_features(
            spark.createDataFrame([(1, 0.5), (7, -0.25)], "idx int, beta double"), feats, 8),
        "provider_winners (1b + 1d together)": ch.provider_winners(charges),
        "global_rank (ranked curve of providers)": ch.ranked_curve(
            ch.provider_win_counts(charges, "charge"), "provider_id", "cnt", 3),
    }
    print(f"# PLANS — physical plans at {sf} (local[8], AQE on)\n")
    print("Generated by `python tools/plans.py`. Operator trees from "
          "`explain(\"formatted\")`; scans list pushed filters and read schema.\n")
    for name, df in plans.items():
        print(f"## {name}\n\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
