import pytest
from pyspark.sql import functions as F

from goldpan.llm import url_filter as uf

CASES = [
    ("HTTP://A.Example.ORG/en/1x?y#z", "a.example.org", "/en/1x", "example.org/en/1", "block"),
    (None, "", "", None, None),
    ("nohost", "", "", None, None),
    ("x://h?q=1/2", "h", "", None, None),
    ("x://org", "org", "", None, None),
    ("x://org/", "org", "/", "org/", "allow"),
    ("a://b://c.org/x", "b:", "//c.org/x", None, None),
    ("://", "", "", None, None),
    ("x://EXAMPLE.org/es/#", "example.org", "/es/", "example.org/es/", "block"),
    ("x://notorg/fr/", "notorg", "/fr/", None, None),
    ("x://sub.com/de/", "sub.com", "/de/", "com/de/", "block"),
    ("x://ÉA.com/FR/", "Éa.com", "/FR/", None, None),
    ("y\n://com/fr/\nz", "com", "/fr/\nz", "com/fr/", "allow"),
]


@pytest.fixture(scope="module")
def cases(spark):
    rows = [(i, c[0], "ignored", "x", "y") for i, c in enumerate(CASES)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, features string")


def test_parts_and_rules(cases):
    found = {r.page_id: r for r in uf.judge(cases).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        assert found[i].verdict == (verdict or found[i].verdict) and found[i].verdict in ("allow", "block")


def test_empty_and_one_sided(spark, cases):
    assert uf.judge(cases.limit(0)).isEmpty()
    one_sided = uf.judge(cases.where("url = 'x://org/' or url is null"))
    assert {r.verdict for r in one_sided.collect()} == {"allow"}


def test_held_out_rules_are_learnt(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    rows = uf.decided(uf.split(pages), uf.RULES)
    test = F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(5)) == 0
    model = uf.fit(rows.where(~test))
    scored = model.trees.transform(uf._with_rates(uf.lexical(rows.where(test & F.col("ruled").isNotNull())), model.rates))
    right = scored.select((F.col("prediction") == F.when(F.col("ruled") == "block", 1.0).otherwise(0.0)).alias("ok"))
    assert right.agg(F.avg(F.col("ok").cast("double"))).first()[0] > 0.9


def test_repeated_urls_and_all_ruled_rows_count(spark):
    """Copies of a URL take no places of the sample; suffix shares come from every ruled row."""
    urls = [f"x://h{i}.org/p{i}/q" for i in range(60)] * 5 + [f"x://s{i}.com/de/{i}" for i in range(60)] * 5
    rows = uf.decided(uf.split(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")), uf.RULES)
    model = uf.fit(rows, most_per_class=10)
    shares = {r.k_two: r.r_two for r in model.rates["two"].collect()}
    assert len(shares) == 120
    assert all(share == pytest.approx(6 / 7 if host.endswith("com") else 1 / 7) for host, share in shares.items())
    assert uf.sampled(rows, 10).select("url").distinct().count() == 20
