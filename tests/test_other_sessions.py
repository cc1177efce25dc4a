"""Reports that see what other sessions load, and streams of batches that break off."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException

import small
from mercata.plans import catalog, generator, jobs
from mercata.sources.warehouse import Warehouse
from mercata.streaming import ingest


@pytest.fixture(scope="module")
def seeded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sessions"))
    source = small.source(spark)
    generator.write_seed(source, f"{root}/seed", small.PLAN)
    wh = Warehouse(spark, f"{root}/wh", buckets=4)
    wh.create()
    jobs.run_seed(wh, f"{root}/seed")
    return root, source, wh


def test_reports_of_another_session_follow(seeded, spark, monkeypatch):
    root, source, wh = seeded
    elsewhere = catalog.Session(Warehouse(spark.newSession(), wh.root))
    registered = []
    register = catalog._register
    monkeypatch.setattr(catalog, "_register", lambda *a: (registered.append(1), register(*a)))
    text = "SELECT * FROM vw_daily_kpi"
    before = elsewhere.sql(text).collect()
    day = generator.write_day(source, f"{root}/in", small.FIRST, small.PLAN)
    jobs.run_batch(wh, f"{root}/in/{day}", day)
    after = elsewhere.sql(text).collect()
    fresh = catalog.view(wh.tables(*catalog.BASE_TABLES), "vw_daily_kpi").collect()
    assert sorted(after) == sorted(fresh) and sorted(after) != sorted(before)
    assert elsewhere.sql("SELECT count(*) FROM vw_customer_summary").first()[0] == 2
    assert len(registered) == 2  # once for each state, not for each statement
    jobs.rollback(wh, [day])
    assert sorted(elsewhere.sql(text).collect()) == sorted(before)


def test_a_stream_that_breaks_off_before_the_audit_goes_on(seeded, spark, monkeypatch):
    root, source, wh = seeded
    days = [generator.write_day(source, f"{root}/in", small.FIRST + dt.timedelta(days=n), small.PLAN) for n in range(2)]
    audited = jobs.write_audit

    def broken(wh, batch_id, started):
        if batch_id == days[1]:
            raise OSError("lost")
        audited(wh, batch_id, started)

    monkeypatch.setattr(jobs, "write_audit", broken)
    with pytest.raises(StreamingQueryException, match="lost"):
        ingest.ingest_batches(wh, f"{root}/in", f"{root}/checkpoint").awaitTermination()
    # The mart has the second day, the audit has not.
    assert set(wh.batch_ids("load_audit")) == {"seed", days[0]} and days[1] in wh.batch_ids("fct_orders")
    rows = {n: wh.read(n).drop("loaded_at").collect() for n in ("fct_orders", "dim_customer", "fct_order_items", "person_batches")}
    monkeypatch.undo()
    ingest.ingest_batches(wh, f"{root}/in", f"{root}/checkpoint").awaitTermination()
    assert set(wh.batch_ids("load_audit")) == {"seed", *days}
    for name, before in rows.items():
        assert sorted(wh.read(name).drop("loaded_at").collect(), key=repr) == sorted(before, key=repr), name
