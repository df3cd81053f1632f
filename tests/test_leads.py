"""P11, P13, P16, W1, W2 on hand-made leads (FIXTURES.md §4 leads)."""

import datetime as dt

from tallyline import labels as L
from tallyline.operators import leads
from tallyline.rules import RuleSet

RULES = RuleSet(
    lead_key_remap=(("111111111", "2222222222"), ("333333333", "2222222222")),
    branch_clients=("500000000", "6000000000", "7000000000"),
    branch_default=(("500000000", "North"),),
    dedup_city_clients=("6000000000",),
    channel_clients=("8000000000",),
    channel_prefixes=(("cl", "C"), ("c", "K")),
)
SCHEMA = ("project string, date_add date, date_time_add timestamp_ntz, inn string, legal_entity string, "
          "source string, company string, name string, phone string, city string, branch string, "
          "send_status string, send_date_time timestamp_ntz, purchase decimal(18,2), sale decimal(18,2), lead_id long")


def lead(i, inn, phone, ts, city="", source="web", sale="10.00", entity="E"):
    t = dt.datetime.fromisoformat(ts)
    return ("p", t.date(), t, inn, entity, source, "co", "n", phone, city, "b", "s", t, None,
            None if sale is None else __import__("decimal").Decimal(sale), i)


ROWS = [
    lead(1, "1000000001", "1", "2024-01-05 10:00:00"),
    lead(2, "1000000001", "1", "2024-01-20 10:00:00"),  # same key, same month -> duplicate
    lead(3, "1000000001", "1", "2024-02-01 10:00:00"),  # next month -> not a duplicate
    lead(4, "111111111", "9", "2024-01-05 10:00:00"),  # remapped
    lead(5, "333333333", "9", "2024-01-06 10:00:00"),  # other raw key, same client: not deduplicated together
    lead(6, "123456789", "7", "2024-01-05 10:00:00"),  # 9 chars -> padded
    lead(7, "500000000", "5", "2024-01-05 10:00:00", city=""),  # default branch
    lead(8, "500000000", "5", "2024-01-06 10:00:00", city=None),  # NULL city -> NULL branch, still a duplicate
    lead(9, "6000000000", "6", "2024-01-05 10:00:00", city="North"),
    lead(10, "6000000000", "6", "2024-01-06 10:00:00", city="South"),  # dedup-by-city client: not a dup
    lead(11, "7000000000", "6", "2024-01-05 10:00:00", city="North"),
    lead(12, "7000000000", "6", "2024-01-06 10:00:00", city="South"),  # branch but not dedup-city: dup
    lead(13, "1000000009", "3", "2024-01-05 10:00:00"),
    lead(14, "1000000009", "3", "2024-01-05 10:00:00"),  # equal timestamps: lower id first
    lead(15, "8000000000", "4", "2024-01-05 10:00:00", source="click"),
    lead(16, "8000000000", "4", "2024-01-05 11:00:00", source="call"),
    lead(17, "8000000000", "4", "2024-01-05 12:00:00", source="web", sale=None),
    lead(18, None, "1", "2024-01-05 10:00:00", sale="0"),
]


def test_keys_branch_channel_and_duplicates(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    keyed = leads.enrich_leads(df, RULES)
    out = {r.lead_id: r for r in leads.flag_duplicates(keyed).collect()}
    dup = {i for i, r in out.items() if r.duplicate_flag == L.DUPLICATE_FLAG}
    assert dup == {2, 8, 12, 14}
    assert out[4].inn == out[5].inn == "2222222222"
    assert out[6].inn == "0123456789"
    assert out[7].city_invoice == "North" and out[8].city_invoice is None
    assert out[9].city_invoice == "North" and out[10].city_invoice == "South"
    assert [out[i].source_invoice for i in (15, 16, 17)] == ["C", "K", ""]
    assert out[1].week_end == dt.date(2024, 1, 7)
    firsts = {r.lead_id for r in leads.first_leads(keyed).collect()}
    assert firsts == set(out) - dup  # exactly one row per duplicate key, nothing lost


def test_latest_entity_from_groups(spark):
    rows = [lead(1, "1000000001", "1", "2024-01-05 10:00:00", entity="old"),
            lead(2, "1000000001", "1", "2024-01-20 10:00:00", entity="new"),  # a duplicate, still counts for W2
            lead(3, "1000000001", "2", "2024-01-10 10:00:00", entity="mid")]
    keyed = leads.enrich_leads(spark.createDataFrame(rows, SCHEMA), RULES)
    from tallyline.functions.dates import Calendar

    acc = leads.lead_accounts(leads.lead_groups(keyed), Calendar.of(dt.date(2024, 1, 25)))
    got = {r.inn: r.legal_entity for r in leads.latest_entity_of(acc).collect()}
    assert got == {"1000000001": "new"}


def test_hot_group_missing_keys_and_repeated_rows(spark):
    """A third of all leads in one group with a missing phone, ties in time,
    a lead without a time (first), and a lead that occurs twice."""
    from collections import defaultdict

    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        ts = f"2024-01-{1 + i * 7 % 28:02d} {i % 5:02d}:00:00"
        rows.append(lead(i, "1000000001" if hot else f"20000{i % 500:05d}", None if hot else str(i % 7), ts))
    rows[1] = rows[1][:2] + (None,) + rows[1][3:]
    rows += [rows[0], rows[1], rows[2]]
    keyed = leads.enrich_leads(spark.createDataFrame(rows, SCHEMA).repartition(4), RULES)
    for salts in (1, 64):
        out = leads.flag_duplicates(keyed, salts).select("lead_id", "duplicate_flag").collect()
        groups = defaultdict(list)
        for r in rows:
            groups[r[3], r[8], r[5], r[1].month].append((r[2] is not None, r[2] or dt.datetime.min, r[15]))
        first = {min(g)[2] for g in groups.values()}
        assert len(out) == len(rows)
        assert all((r.duplicate_flag == "") == (r.lead_id in first) for r in out)


def test_no_leads(spark):
    keyed = leads.enrich_leads(spark.createDataFrame([], SCHEMA), RULES)
    assert leads.flag_duplicates(keyed).collect() == []
