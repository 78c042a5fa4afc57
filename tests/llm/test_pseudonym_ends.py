"""IBANs before other words, and dates with the day first."""

import datetime

from pyspark.sql import functions as F
from test_scans import iban_ok, shape

from vectable.llm import pseudonyms


def test_ibans_end_where_the_number_does(spark):
    texts = ["AT61 1904 3002 3457 3201 EUR", "BE68 5390 0754 7034 2024", "ES91 2100 0418 4502 0005 1332 A", "DE89 3704 0044 0532 0130 00 ABCD"]
    cut = [24, 19, 29, 27]
    out = {r.doc_id: r for r in pseudonyms.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "key").collect()}
    for k, (t, n) in enumerate(zip(texts, cut)):
        new = out[k].text
        assert out[k].pii == ["iban"] and new[n:] == t[n:] and new[:n] != t[:n], new
        assert iban_ok(new[:n]) and new[:2] == t[:2] and shape(new) == shape(t)


def test_dates_with_the_day_first(spark):
    days = [datetime.date(1800, 1, 1) + datetime.timedelta(k) for k in range(0, 146097, 7)]
    days = [d for d in days if d.day > 12]
    df = spark.createDataFrame([(k, d.strftime("on %d/%m/%Y.")) for k, d in enumerate(days)], "doc_id bigint, text string")
    out = pseudonyms.pseudonymise(df, "key").collect()
    new = {datetime.datetime.strptime(r.text, "on %d/%m/%Y.").date() for r in out}
    assert all(r.pii == ["date"] for r in out)
    assert len(new) == len(days) and all(d.day > 12 and 1800 <= d.year < 2200 for d in new)
    assert spark.range(1).select(pseudonyms.date_of(F.lit("25/13/2020"))).first()[0] is None
