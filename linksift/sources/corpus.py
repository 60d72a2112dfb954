"""Labelled URL corpus derived from the ``pages`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linksift.sources.tables import dealt, table

# Variant number, URL template ({id} = page_id), label.
# Variant 0 is the page's own URL and is labelled by its host.
VARIANTS = (
    (1, "http://steam-account-alert.ga/confirm?case={id}", 1),
    (2, "https://docs.python.org/3/search.html?q=frame+{id}", 0),
    (3, "http://10.20.30.40/panel/signin.php?member=root{id}", 1),
    (4, "http://xn--mazon-3ve.com/orders/renew/{id}", 1),
    (5, "https://tinyurl.com/{id}", 1),
    (6, "https://spark.apache.org/docs/latest/{id}", 0),
    (7, "http://netflix-billing-notice.cf/confirm/card?session=zz{id}", 1),
    (8, "https://icloud-unlock.weebly.com/signin/restore/{id}", 1),
    (9, "http://gооgle.com/signin/{id}", 1),
    (10, "http://account-apple.com.evil.ga/signin/{id}", 1),
    (11, "https://sberbank-kabinet.ru/signin?session=xyz{id}", 1),
    (12, "http://госуслуги-портал.рф/войти/{id}", 1),
    (13, "http://user@evil.example.com:8080//redirect?url=http%3A%2F%2Fx&id={id}", 1),
    (14, "http://0xC0A80001/files/invoice{id}.pdf.html", 1),
    (15, "http://a.b.c.d.paypa1.com/update/{id}/x.zip", 1),
    (16, "http://x.top/??win!!!&a=1&b=2&c=3&d=4&e=5&f={id}", 1),
    (17, "http://cdn.example.net/deadbeefcafebabe{id}/%41%42%43%44", 0),
    (18, "paypal.com.verify.xyz/{id}", 1),
    (19, "https://[::1]:8443/a;v=1/b;p=2?k={id}#frag", 0),
    (20, "   ", 0),
)
#: Pages whose URLs one task makes and parses; each page has 21.
PAGES_A_TASK = 1_000
BAD_HOST_PARTS = ("spam-farm", "cheap-pills")


def url_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages x variants: url_id, page_id, variant, url, label (2 % of labels flipped)."""
    pages = dealt(table(spark, sf_dir, "pages").select("page_id", "url"), PAGES_A_TASK, "page_id")
    own_label = F.when(
        F.col("url").contains(BAD_HOST_PARTS[0]) | F.col("url").contains(BAD_HOST_PARTS[1]), 1
    ).otherwise(0)
    entries = [F.struct(F.lit(0).alias("variant"), F.col("url").alias("url"), own_label.alias("label"))]
    for variant, template, label in VARIANTS:
        entries.append(
            F.struct(
                F.lit(variant).alias("variant"),
                F.replace(F.lit(template), F.lit("{id}"), F.col("page_id").cast("string")).alias("url"),
                F.lit(label).alias("label"),
            )
        )
    url_id = F.col("page_id") * 100 + F.col("variant")
    return (
        pages.select("page_id", F.inline(F.array(*entries)))
        .select(
            url_id.alias("url_id"),
            "page_id",
            "variant",
            "url",
            F.when(url_id % 50 == 7, 1 - F.col("label")).otherwise(F.col("label")).alias("label"),
        )
    )
