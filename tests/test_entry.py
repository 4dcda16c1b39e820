import __spark_entry__ as e


def test_contract(spark):
    q, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(q) and "p6_found" in q
    assert e.entry(spark).columns[:2] == ["source1_entity_id", "candidate_entity_id"]
