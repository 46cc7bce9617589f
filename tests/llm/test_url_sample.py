from shillingflow.llm import urls


def test_a_frequent_url_is_drawn_by_its_share(spark, monkeypatch):
    frequent = "http://shop.example.net/" + "x" * 150
    rows = [(frequent,)] * 1000 + [(f"http://h{i % 50}.org/fr/{i}",) for i in range(2000)]
    pages = spark.createDataFrame(rows, "url string")
    labelled = urls.lexical(urls.with_rule(urls.with_parts(pages)).filter("rule_verdict is not null"))
    samples, write = [], urls.write_out
    monkeypatch.setattr(urls, "write_out", lambda df, name: samples.append(write(df, name)) or samples[-1])
    for seed in (1, 2, 3):
        assert urls.fit(labelled, fit_rows=300, trees=1, seed=seed) is not None
        got = samples[-1].selectExpr("length > 150 AS frequent", "weight").collect()
        assert len(got) < 300 and 99 <= sum(r.weight for r in got if r.frequent) <= 101
        assert 250 < sum(r.weight for r in got) < 350
