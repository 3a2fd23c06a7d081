"""Rule chains, validity flags and splits: order, NULL handling, totality."""

from stratum.plans import merchants, transactions, users

TX_COLS = ("_seq long, transaction_id string, user_id string, merchant_id string, amount string, "
           "transaction_type string, channel string, status string, currency string, "
           "transaction_date string, reference_id string")
GOOD = (1, "TXN-20240105-00001", "USR-000001", "MCH-00001", "10,50", " Pago ", "WEB", "APROBADO",
        "sol", "2024-01-05", None)


def tx(spark, *rows):
    return spark.createDataFrame(list(rows), TX_COLS)


def reasons(df):
    return {r._seq: r.rejection_reason for r in df.select("_seq", "rejection_reason").collect()}


def with_(row, **kw):
    names = [c.split()[0] for c in TX_COLS.split(", ")]
    d = dict(zip(names, row))
    d.update(kw)
    return tuple(d[n] for n in names)


def test_valid_row_passes_and_is_normalised(spark):
    v = transactions.validate(tx(spark, GOOD))
    row = v.collect()[0]
    assert row.rejection_reason is None
    assert (row.amount, row.transaction_type, row.channel, row.status, row.currency) == \
        (10.5, "pago", "web", "aprobado", "PEN")


def test_each_rule_fires_with_its_reason(spark):
    cases = {
        2: (dict(transaction_id="TX-1"), transactions.R_TXN_FORMAT),
        3: (dict(user_id=None), transactions.R_USER_NULL),
        4: (dict(user_id="U1"), transactions.R_USER_FORMAT),
        5: (dict(merchant_id=None), transactions.R_MERCHANT_NULL),
        6: (dict(merchant_id="M1"), transactions.R_MERCHANT_FORMAT),
        7: (dict(amount="abc"), transactions.R_AMOUNT_NULL),
        8: (dict(amount="-5.00"), transactions.R_AMOUNT_NONPOSITIVE),
        9: (dict(transaction_type="transfer"), transactions.R_TYPE),
        10: (dict(channel="fax"), transactions.R_CHANNEL),
        11: (dict(status="unknown"), transactions.R_STATUS),
        12: (dict(currency="EUR"), transactions.R_CURRENCY),
        13: (dict(transaction_date="2024-02-30"), transactions.R_DATE),
        14: (dict(transaction_type="Reversa"), transactions.R_REVERSAL_NEEDS_REF),
        15: (dict(reference_id="TXN-X"), transactions.R_REF_MUST_BE_NULL),
    }
    rows = []
    for k, (kw, _) in cases.items():
        d = dict(_seq=k, transaction_id=f"TXN-20240105-{k:05d}")
        d.update(kw)
        rows.append(with_(GOOD, **d))
    got = reasons(transactions.validate(tx(spark, *rows)))
    assert got == {k: reason for k, (_, reason) in cases.items()}


def test_first_failing_rule_wins(spark):
    row = with_(GOOD, user_id="U1", amount="abc", channel="fax")
    assert reasons(transactions.validate(tx(spark, row))) == {1: transactions.R_USER_FORMAT}


def test_null_domain_values_pass(spark):
    # NOT (NULL IN (...)) is NULL: the rule does not fire.
    row = with_(GOOD, channel=None, status=None, currency=None)
    assert reasons(transactions.validate(tx(spark, row))) == {1: None}


def test_null_type_fires_neither_reversal_rule(spark):
    row = with_(GOOD, transaction_type=None, reference_id="TXN-REF-1")
    assert reasons(transactions.validate(tx(spark, row))) == {1: None}


def test_ids_are_not_trimmed(spark):
    row = with_(GOOD, transaction_id=" TXN-20240105-00001")
    assert reasons(transactions.validate(tx(spark, row))) == {1: transactions.R_TXN_FORMAT}


def test_dedup_before_rules_lets_invalid_first_copy_shadow_valid_copy(spark):
    first = with_(GOOD, _seq=1, amount="abc")
    later = with_(GOOD, _seq=2)
    v = transactions.validate(tx(spark, later, first))
    assert reasons(v) == {1: transactions.R_AMOUNT_NULL}


def test_null_keys_collapse_to_one_row(spark):
    rows = [with_(GOOD, _seq=k, transaction_id=None) for k in (5, 3, 9)]
    v = transactions.validate(tx(spark, *rows))
    assert reasons(v) == {3: transactions.R_TXN_NULL}


def test_merchant_rules(spark):
    cols = ("_seq long, merchant_id string, merchant_name string, category string, country string, "
            "affiliation_date string, status string, risk_level string")
    base = dict(merchant_id="MCH-00001", merchant_name="M", category=" Retail", country=" mexico ",
                affiliation_date="17/05/2023", status="SUSPENDED", risk_level=None)
    cases = [
        ({}, None),
        (dict(merchant_id=None), merchants.R_ID_NULL),
        (dict(merchant_id="M-1"), merchants.R_ID_FORMAT),
        (dict(merchant_name="   "), merchants.R_NAME),
        (dict(category="casino"), merchants.R_CATEGORY),
        (dict(country="BRASIL"), merchants.R_COUNTRY),
        (dict(affiliation_date="31-12-2023"), merchants.R_DATE),
        (dict(status="closed"), merchants.R_STATUS),
        (dict(risk_level="extremo"), merchants.R_RISK),
        (dict(country=None, category=None, status=None), None),
    ]
    rows = []
    for i, (kw, _) in enumerate(cases):
        d = dict(base, **kw)
        if d["merchant_id"] == "MCH-00001":
            d["merchant_id"] = f"MCH-{i:05d}"
        rows.append((i, d["merchant_id"], d["merchant_name"], d["category"], d["country"],
                     d["affiliation_date"], d["status"], d["risk_level"]))
    v = merchants.validate(spark.createDataFrame(rows, cols))
    got = {r._seq: r.rejection_reason for r in v.collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(cases)}
    ok = v.filter("_seq = 0").collect()[0]
    assert (ok.category, ok.country, ok.status) == ("retail", "MX", "suspendido")


USER_LINES = [
    (1, " USR-000001|Ana|40000001|User.1@Example.COM |+51 999-000001|Peru|ESTANDAR|15/03/2024 "),
    (2, "USR-000002|Bo|40000002|b@x.io|56 9 00000002|chi||2024-03-15"),         # blank segment
    (3, "USR-000003|Cy|12-345|c@x.io|+51 ext abc|Peru|nuevo|2024-03-15"),     # doc, letters
    (4, "USR-000004|Dee"),                                                    # 2 fields
    (5, None),                                                                # null line
    (6, "user_id|full_name|document_id|email|phone|country|segment|registration_date"),
    (7, "USR-000007|Ed|40000007|e@x.io|57 0000000007|Peru|nuevo|31/02/2024"),  # phone/country
]


def user_frame(spark):
    return spark.createDataFrame(USER_LINES, "_seq long, value string")


def test_structural_split_is_total(spark):
    ok, bad = users.split_lines(user_frame(spark), keep=("_seq",))
    assert sorted(r._seq for r in ok.collect()) == [1, 2, 3, 6, 7]
    bad_rows = {r._seq: r for r in bad.collect()}
    assert sorted(bad_rows) == [4, 5]
    assert bad_rows[4].error_type == users.STRUCTURE_ERROR_TYPE


def test_user_flags_and_split(spark):
    flagged = users.validated(user_frame(spark), keep=("_seq",))
    f = {r._seq: r for r in flagged.collect()}
    assert f[1].user_id == "USR-000001" and f[1].email == "user.1@example.com"
    assert f[1].country == "PE" and f[1].segment == "estandar"
    assert f[1].is_valid_phone and f[1].is_valid_registration_date
    assert f[2].is_valid_segment is False  # '' is not NULL
    assert f[3].is_valid_document_id is False
    assert f[3].phone_has_letters and f[3].phone_clean is None
    assert f[3].is_valid_phone is False and f[3].is_valid_phone_format is None
    assert f[7].phone_country_code == "CO" and f[7].is_valid_phone is False
    assert f[7].is_valid_phone_format is True and f[7].is_valid_registration_date is False
    good, bad = users.clean_and_quarantine(flagged)
    assert [r._seq for r in good.collect()] == [1]
    q = {r._seq: r for r in bad.collect()}
    assert sorted(q) == [2, 3, 6, 7]
    assert q[2].error_type == users.RULE_ERROR_TYPE and q[2].error_reason == "is_valid_segment"


def test_dq_summary_counts_false_not_null(spark):
    s = users.summary(users.validated(user_frame(spark), keep=("_seq",))).collect()[0]
    # Row 3 has letters in the phone: its format flag is NULL, not counted.
    assert s.invalid_phone == 0
    assert s.invalid_segment == 2  # '' and the header's 'segment'
    assert s.invalid_document_id == 2


def test_row_counts_one_pass(spark):
    r = users.row_counts(user_frame(spark)).collect()[0]
    assert (r.total_lines, r.structurally_valid, r.structure_rejects, r.clean, r.quarantined) == \
        (7, 5, 2, 1, 4)


def test_quarantine_envelope_json(spark):
    row = with_(GOOD, user_id="U1")
    q = transactions.quarantine(transactions.validate(tx(spark, row))).collect()[0]
    assert q.source_name == "transactions" and q.rejection_reason == transactions.R_USER_FORMAT
    import json
    rec = json.loads(q.original_record)
    assert rec["amount"] == 10.5 and rec["rejection_reason"] == transactions.R_USER_FORMAT
    assert "reference_id" not in rec  # NULL fields are omitted


def test_rules_compile_inside_codegen(spark):
    v = transactions.validate(tx(spark, GOOD))
    plan = v._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
