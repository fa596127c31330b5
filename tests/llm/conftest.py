import pytest

LONG = "zupf ertion " * 20_000


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    """Tables with nulls, empty and very long texts, ties, repeated rows and extra columns with clashing names."""
    at = str(tmp_path_factory.mktemp("odd"))
    passage = "one two three four five six seven eight nine ten eleven twelve"
    docs = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "Short"),
        (5, passage),
        (6, f"before it {passage.upper()} and after"),
        (7, "one two three four five six seven eight nine but not ten"),
        (8, LONG),
        (9, LONG + "CC-BY 4.0 a@b.de"),
        (10, "All rights reserved. all RIGHTS reserved; General Public License cc by cc by"),
        (11, "ü mail a.b@c.de x@y@z.com..d@e.f, 1.2.3.4.5.6.7.8 999.1.1.1 +1 (555) 555-1234 4111 1111 1111 1111"),
        (11, "ü mail a.b@c.de x@y@z.com..d@e.f, 1.2.3.4.5.6.7.8 999.1.1.1 +1 (555) 555-1234 4111 1111 1111 1111"),
        (12, "short"),
        (13, "Licensed under the Apache License, Version 2.0. Released under the MIT License"),
        (14, "password=d9f3929e83c8655244 token = \"a1b84aa797bff9a565724754d944aa08baf4e19f\""),
        (15, "1234567890123456 " * 3000 + "0" * 5000 + "@" * 50 + "a" * 5000),
        (-(1 << 40), "tie one tie one tie one"),
        (1 << 40, "tie one tie one tie one"),
    ]
    docs += [(100 + k, f"same text again {k // 20}") for k in range(60)]
    rows = [(d, t, "en", "s", len(t or ""), 1, "x", None, 0.5) for d, t in docs]
    names = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, code string, hub string, score double"
    spark.createDataFrame(rows, names).repartition(3).write.parquet(f"{at}/documents.parquet")
    items = [(1, passage), (2, "nine but not ten"), (3, None), (4, ""), (5, "SHORT"), (None, passage), (6, passage), (1, passage), (7, "tie one tie one tie"), (8, "x " * 30)]
    spark.createDataFrame([(*i, 1, "y") for i in items], "item_id bigint, text string, hash int, n string").write.parquet(f"{at}/benchmark.parquet")
    labels = [(d, int(d % 2), int(d % 3 == 0)) for d, _ in docs if d > 3] + [(5, None, None), (None, 1, 1), (9999, 1, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    urls = [None, "", "no scheme", "http://", "https://NET/", "http://a.net", "http://a.net/x?y", "http://Example.NET/en/1#f", "http://example.net/en", "http://x.example.com/de/a", "http://example.com/fr/", "http://a.org/fr/b", "http://org/fr/", "http://notorg/fr/", "http://..net/", "http://a://b.org/fr/", "http://x.casino-win.example.com/", "http://xnet/", "ftp://u@h.net:80/a"]
    pages = [(k, u, "h", "z") for k, u in enumerate([*urls, *urls])]
    spark.createDataFrame(pages, "page_id bigint, url string, html string, key string").write.parquet(f"{at}/pages.parquet")
    nan, inf = float("nan"), float("inf")
    vectors = [(None, [1.0, 2.0, 3.0]), (1, None), (2, []), (3, [1.0, None, 2.0]), (4, [nan, 0.0, 0.0]), (5, [0.0, inf, 0.0]), (6, [1.0, 2.0]), (7, [0.1, -0.2, 0.3]), (7, [0.1, -0.2, 0.3]), (8, [5.0, -1.0, 0.25]), (9, [-3.0, 0.5, 0.125]), (9, [2.0, 2.0, 2.0]), (10, [1e30, 0.0, 0.0])]
    spark.createDataFrame([(*v, 1, 2) for v in vectors], "vec_id bigint, embedding array<float>, label int, n int").repartition(3).write.parquet(f"{at}/embeddings.parquet")
    return at


@pytest.fixture(scope="session")
def empty_dir(spark, odd_dir, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "benchmark", "labels", "pages", "embeddings"):
        spark.read.parquet(f"{odd_dir}/{name}.parquet").limit(0).write.parquet(f"{at}/{name}.parquet")
    return at
