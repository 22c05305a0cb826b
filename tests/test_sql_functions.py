from conftest import rows
from dayfold.functions import folder_name, sql


def test_folder_name(spark, frame):
    sql.register_folder_name(spark)
    assert spark.sql("SELECT get_folder_name(2025, 1, 'zurich'), get_folder_name(2024, 12)").first() == (
        "zurich_2025_january", "zurich_2024_december")
    df = frame([(y, m, l) for y in (2024, 1999) for m in (1, 2, 9) for l in ("Basel", "")], "y int, m int, l string")
    df.createOrReplaceTempView("folder_rows")
    assert rows(spark.sql("SELECT get_folder_name(y, m, l) FROM folder_rows")) == rows(df.select(folder_name("l", "y", "m")))


def test_progress_of_one_and_of_many_jobs(spark, frame):
    frame([(1, 5, 1), (1, None, 2), (2, 7, 0)], "master_job_id long, files_processed int, files_failed int").createOrReplaceTempView(
        sql.TRACKING)
    sql.register_progress(spark)
    assert rows(spark.sql("SELECT * FROM parallel_progress(1)")) == [(2, 5, 3)]
    assert rows(spark.sql("SELECT * FROM parallel_progress(9)")) == [(0, 0, 0)]
    many = spark.sql(f"SELECT m, p.* FROM (SELECT DISTINCT master_job_id AS m FROM {sql.TRACKING}), LATERAL parallel_progress(m) p")
    assert rows(many) == [(1, 2, 5, 3), (2, 1, 7, 0)]
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "CartesianProduct" not in plan
