"""Incremental ingest: each landed file is parsed once, restarts resume."""

from claimlens import streaming


def test_claims_ingest_is_incremental(spark, tmp_path):
    land, out, ckpt = tmp_path / "land", str(tmp_path / "out"), str(tmp_path / "ckpt")
    land.mkdir()
    (land / "m01.txt").write_text("20110101\x1fp1\x1f0604\x1e20110102\x1fp2\x1f0019\x1e")
    streaming.ingest(streaming.stream_claims(spark, str(land)), out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    (land / "m02.txt").write_text("20110201\x1fp3\x1f0698\x1e")
    streaming.ingest(streaming.stream_claims(spark, str(land)), out, ckpt).awaitTermination()
    rows = sorted(r.patient_id for r in spark.read.parquet(out).collect())
    assert rows == ["p1", "p2", "p3"]


def test_patients_stream(spark, tmp_path):
    land, out = tmp_path / "land", str(tmp_path / "out")
    land.mkdir()
    (land / "p.xml").write_text('<rows><field name="id">9</field><field name="gndr">F</field></rows>\n')
    streaming.ingest(streaming.stream_patients(spark, str(land)), out,
                     str(tmp_path / "ck")).awaitTermination()
    r = spark.read.parquet(out).first()
    assert (r.id, r.gender, r.age) == ("9", "F", "")


def test_charges_stream(spark, tmp_path):
    import gzip

    from claimlens import schemas
    ind, outd = tmp_path / "in", tmp_path / "out"
    ind.mkdir()
    outd.mkdir()
    head_i = ",".join(schemas.INPATIENT.fieldNames())
    head_o = ",".join(schemas.OUTPATIENT.fieldNames())
    with gzip.open(ind / "a.csv.gz", "wt") as f:
        f.write(head_i + '\n"039 - X","010001","A","B","C","AL","1","AL - D","91","32963.07","5777.24"\n')
    (outd / "b.csv").write_text(head_o + '\n"0604 - Y","10","A","B","C","AL","1","AL - D","2","n/a","1"\n')
    res = str(tmp_path / "charges")
    streaming.ingest(streaming.stream_charges(spark, str(ind), str(outd)), res,
                     str(tmp_path / "ck")).awaitTermination()
    rows = {r.type: r for r in spark.read.parquet(res).collect()}
    assert rows["I"].avg_charged_amount == 32963.07 and rows["O"].avg_charged_amount is None


def test_a_second_call_without_a_checkpoint_resumes(spark, tmp_path):
    land, out = tmp_path / "land2", str(tmp_path / "out2")
    land.mkdir()
    (land / "m01.txt").write_text("20110101\x1fp1\x1f0604\x1e")
    streaming.ingest(streaming.stream_claims(spark, str(land)), out).awaitTermination()
    (land / "m02.txt").write_text("20110201\x1fp2\x1f0698\x1e")
    streaming.ingest(streaming.stream_claims(spark, str(land)), out).awaitTermination()
    assert sorted(r.patient_id for r in spark.read.parquet(out).collect()) == ["p1", "p2"]
