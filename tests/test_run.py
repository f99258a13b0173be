"""The whole flow on the sf0.001 stand-in feeds, from raw files."""

from claimlens import sinks
from claimlens.plans import standins as si
from claimlens.plans.part3 import Part3Config
from claimlens.plans.run import FeedPaths, run_all

SF = "/root/testdata/sf0.001"


def test_run_all_from_raw_files(spark, tmp_path):
    feeds = FeedPaths(*(str(tmp_path / n) for n in ("in", "out", "pat", "claims", "review")))
    sinks.write_quoted_csv(si.inpatient_feed(spark, SF), feeds.inpatient)
    sinks.write_quoted_csv(si.outpatient_feed(spark, SF), feeds.outpatient)
    sinks.write_tagged_xml(si.patient_feed(spark, SF), feeds.patients)
    sinks.write_control_delimited(si.claim_feed(spark, SF), feeds.claims)
    sinks.write_id_list(si.review_feed(spark, SF), feeds.review)
    tables, result = run_all(spark, feeds, str(tmp_path / "run"), Part3Config(seed=1, top_n=20))
    assert tables["patientclaim"].count() == si.claim_feed(spark, SF).count()
    assert tables["in_out_patient"].count() == si.table(spark, SF, "lineitem").count()
    for q in ("part1a", "part1b", "part1c", "part1d", "part2a", "part2b", "suspicious"):
        lines = spark.read.text(str(tmp_path / "run" / "results" / q)).collect()
        assert 0 < len(lines) <= (20 if q == "suspicious" else 3)
