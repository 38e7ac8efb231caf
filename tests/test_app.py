from solospan import app

SAMPLE = "197.203.0.0, 197.206.9.255\n197.204.0.0,197.204.0.24\n201.233.7.160, 201.233.7.168\n201.233.7.164, 201.233.7.168\n201.233.7.167, 201.233.7.167\n203.133.0.0, 203.133.255.255\n"


def test_application_run_numbers_and_publishes_sets(spark, tmp_path):
    a = tmp_path / "a.txt"
    a.write_text(SAMPLE + "garbage\n")
    b = tmp_path / "b.txt"
    b.write_text("1.0.0.0, 1.0.0.9\n1.0.0.5, 1.0.0.20\n")
    tables = str(tmp_path / "tables")
    assert app.run(spark, [str(a), str(b)], tables, listing=str(tmp_path / "listing")) == [1, 2]
    out = spark.read.parquet(f"{tables}/output")
    assert out.where("set_id = 1").count() == 4 and out.where("set_id = 2").count() == 2
    assert spark.read.parquet(f"{tables}/rejects").count() == 1
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "listing")).collect())
    assert "1\t197.203.0.0, 197.203.255.255" in lines and len(lines) == 6
    # a second run continues the numbering
    assert app.run(spark, [str(b)], tables) == [3]
