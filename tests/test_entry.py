import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "title", "creation_date", "score", "owner_user_id",
                          "reputation", "vote_type_id", "label"]


def test_registry_contract():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
    for k, fn in q.items():
        assert fn.__doc__, k
