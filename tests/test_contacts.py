from parley.plans import contacts, staging
from tests.handmade import sources

RECORDS = [(1, "Ann", "Lee"), (2, "Ann", "Lee"), (3, None, "Moe"), (4, None, None), (5, "Zed", None)]
PHONES = [
    (1, "5550000001", 1), (1, "5550000001", 0), (2, "5550000001", 5), (1, "5550000002", 2),
    (3, "  ", 0), (3, "911", 0), (4, "+445550000003", 0), (77, "5550000009", 0),
]


def staged(spark, ordered=False):
    s = sources(spark, [], records=RECORDS, phones=PHONES)
    return staging.stg_contacts(s.record, s.phone, ordered)


def test_distinct_contacts_keep_those_without_phone(spark):
    rows = [tuple(r) for r in staged(spark, ordered=True).collect()]
    assert rows == [
        ("Ann", "Lee", "5550000001"),
        ("Ann", "Lee", "5550000002"),
        (None, "Moe", "  "),
        (None, "Moe", "911"),
        ("Zed", None, None),
        (None, None, "+445550000003"),
    ] or rows == [
        ("Ann", "Lee", "5550000001"),
        ("Ann", "Lee", "5550000002"),
        (None, "Moe", "911"),
        (None, "Moe", "  "),
        ("Zed", None, None),
        (None, None, "+445550000003"),
    ]


def test_normalized_contacts(spark):
    got = {
        r.full_number: (r.contact_display_name, r.normalized_number, r.phone_type, r.digit_count, r.contact_priority)
        for r in contacts.contacts_normalized(staged(spark)).collect()
    }
    assert got == {
        "5550000001": ("Ann Lee", "5550000001", "us_local", 10, 1),
        "5550000002": ("Ann Lee", "5550000002", "us_local", 10, 1),
        "+445550000003": (None, "445550000003", "international", 12, 2),
    }
