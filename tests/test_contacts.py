"""CRM operators: outcomes on sf0.001 and rule-level checks."""

from pyspark.sql import functions as F

from fieldlake.operators import contacts as G
from fieldlake.registry_ops import crm_existing
from fieldlake.sources.testdata import load


def _counts(df, col="action"):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def test_upsert_outcomes(spark, sf):
    plan = G.upsert_plan(load(spark, sf, "raw_customers"), load(spark, sf, "raw_subscriptions"),
                         crm_existing(spark, sf))
    c = _counts(plan)
    assert c == {"created": 68, "updated": 35, "skipped_no_contact": 20}
    assert _counts(G.upsert_plan(load(spark, sf, "raw_customers"), load(spark, sf, "raw_subscriptions"),
                                 crm_existing(spark, sf), office=2)) == {"updated": 25}


def test_import_outcomes(spark, sf):
    contacts = G.contactable(G.contacts_import(load(spark, sf, "raw_customers")))
    c = _counts(G.import_dedupe(contacts, crm_existing(spark, sf)))
    assert c == {"created": 49, "created_no_email": 12, "created_no_phone": 31,
                 "created_no_email_no_phone": 8}


def test_service_tag_rules(spark):
    rows = [("Rodent Baiting Program", "0"), ("Rodent Inspection", "1"), ("Free Estimate", "1"),
            ("Termite Treatment", "1"), ("Termite Treatment Wood", "1"), ("Mosquito Plan", "0"),
            ("Rodent Exclusion", "1"), ("Rodent Cleanup", "1"), ("Bed Bug Heater Rental", "true"),
            ("Bed Bug Treatment", "1"), ("Actisol", "1"), ("Bee Removal", "1"), ("Roach Special", "1"),
            ("", "1"), ("Pigeon Netting", "1"), ("Deep Root Feeding", "1"), ("Weed Control", "1")]
    df = spark.createDataFrame(rows, "serviceType string, active string")
    got = [r[0] for r in df.select(G.service_tag(F.col("serviceType"), G.sub_active(F.col("active")))).collect()]
    assert got == ["svc_rodent_baiting", None, None, "svc_termite", None, None, "svc_rodent_service", None,
                   "svc_heater_rental", "svc_bedbug", "svc_bedbug", "svc_bee", "svc_pest", None, "svc_bird",
                   "svc_deep_root", "svc_weed"]


def test_tag_merge_keeps_order_and_unmanaged_tags(spark):
    df = spark.createDataFrame([(["vip", "fr_inactive", "svc_pest", "fr_office1"],
                                 ["fr_office1", "fr_active", "fr_residential", "svc_bee"])],
                               "old array<string>, new array<string>")
    got = df.select(G.merge_tags(F.col("old"), F.col("new"))).first()[0]
    assert got == ["vip", "fr_office1", "fr_active", "fr_residential", "svc_bee"]


def test_all_tags_occur(spark, sf):
    tags = G.service_tags(G.tag_subscriptions(load(spark, sf, "raw_subscriptions")))
    seen = {r[0] for r in tags.select(F.explode("svc_tags")).distinct().collect()}
    assert seen == set(G.SERVICE_TAGS)


def _raw(spark, rows):
    return spark.createDataFrame([(i, o, e, p) for i, o, e, p in rows],
                                 "customerID string, officeID string, email string, phone1 string") \
        .selectExpr("*", "'' AS phone2", "'F' AS fname", "'L' AS lname", "'' AS companyName", "'' AS address",
                    "'' AS city", "'' AS state", "'' AS zip", "'1' AS active", "'0' AS commercialAccount")


def test_upsert_finds_earlier_contacts_of_the_batch(spark):
    raw = _raw(spark, [("10", "1", "a@x.com", None), ("9", "1", "a@x.com", "7025550001"), ("11", "1", None, "7025550001"),
                       ("12", "1", "b@x.com", "7025550001"), ("13", "2", "a@x.com", None), ("14", "1", "c@x.com", None),
                       ("15", "1", None, None), ("-1", "-1", "a@x.com", None)])
    subs = spark.createDataFrame([("9", "1", "Bee Removal", "1", "3"), ("9", "2", "Weed Control", "1", "3")],
                                 "customerID string, officeID string, serviceType string, active string, serviceID string")
    crm = spark.createDataFrame([(5, "c@x.com", None, ["vip", "svc_weed"])],
                                "contact_id long, email string, phone string, tags array<string>")
    got = {r["fr_id"]: (r["action"], r["contact_id"], r["same_as"], r["tags"])
           for r in G.upsert_plan(raw, subs, crm).collect()}
    mine = ["fr_office1", "fr_active", "fr_residential"]
    moved = ["fr_office1", "fr_residential", "fr_active"]
    # 12 has a new email, so its phone finds the contact; all three reach the one of 9
    assert got == {"9": ("created", None, None, [*mine, "svc_bee"]), "10": ("updated", None, "9", moved),
                   "11": ("updated", None, "9", moved), "12": ("updated", None, "9", moved),
                   "14": ("updated", 5, None, ["vip", *mine]), "15": ("skipped_no_contact", None, None, mine),
                   "-1": ("skipped_orphaned", None, None, mine)}
    two = {r["fr_id"]: (r["action"], r["tags"]) for r in G.upsert_plan(raw, subs, crm, office=2).collect()}
    assert two["13"] == ("created", ["fr_office2", "fr_active", "fr_residential"]) and set(two) == {"13", "-1"}


def _one_after_the_other(rows, crm):
    """The source's loop: look for the email, then the phone; an address stays
    with the contact that had it first."""
    contacts = {f"c{i}": list(tags or []) for i, _, _, tags in crm}
    emails, phones, out = {}, {}, {}
    for i, email, phone, _ in sorted(crm):
        emails.setdefault(email, f"c{i}") if email else None
        phones.setdefault(phone, f"c{i}") if phone else None
    for fr_id, email, phone, own in sorted(rows, key=lambda r: int(r[0])):
        if not (email or phone):
            continue
        found = (emails.get(email) if email else None) or (phones.get(phone) if phone else None)
        at = found or f"b{fr_id}"
        if found:
            kept = [t for t in contacts[at] if t not in ("fr_active", "fr_inactive") and not t.startswith("svc_")]
            contacts[at] = list(dict.fromkeys(kept + own))
        else:
            contacts[at] = own
        if email:
            emails.setdefault(email, at)
        if phone:
            phones.setdefault(phone, at)
        out[fr_id] = ("updated" if found else "created", at, contacts[at])
    return out


def _planned(spark, rows, crm):
    raw = spark.createDataFrame([(i, "1", e, p, commercial) for i, e, p, commercial in rows],
                                "customerID string, officeID string, email string, phone1 string, commercialAccount string") \
        .selectExpr("*", "'' AS phone2", "'F' AS fname", "'L' AS lname", "'' AS companyName", "'' AS address",
                    "'' AS city", "'' AS state", "'' AS zip", "'1' AS active")
    subs = spark.createDataFrame([(rows[0][0], "1", "Bee Removal", "1", "3")],
                                 "customerID string, officeID string, serviceType string, active string, serviceID string")
    existing = spark.createDataFrame(crm, "contact_id long, email string, phone string, tags array<string>")
    got = {r["fr_id"]: ("b" + r["created_by"] if r["contact_id"] is None else f"c{r['contact_id']}", r["action"], r["tags"])
           for r in G.upsert_plan(raw, subs, existing).collect() if not r["action"].startswith("skipped")}
    own = lambda i, c: (["fr_office1", "fr_active", "fr_commercial" if c == "1" else "fr_residential"]
                        + (["svc_bee"] if i == rows[0][0] else []))
    want = _one_after_the_other([(i, e, p, own(i, c)) for i, e, p, c in rows], crm)
    return got, {k: (at, action, tags) for k, (action, at, tags) in want.items()}


def test_upsert_tags_add_up_along_chains(spark):
    import random
    phone = lambda n: f"+1702555{n:04d}"
    # a chain: each finds the one before by its phone or its email in turn
    chain = [(str(i), f"e{(i + 1) // 2}@x.com", phone(i // 2), str(int(i in (3, 40)))) for i in range(1, 60)]
    got, want = _planned(spark, chain, [(7, "e1@x.com", None, ["vip", "svc_pest", "fr_inactive"])])
    assert got == want and {at for at, _, _ in got.values()} == {"c7"}
    assert got["59"][2] == ["vip", "fr_office1", "fr_residential", "fr_commercial", "fr_active"]
    got, want = _planned(spark, chain, [])
    assert got == want and {at for at, _, _ in got.values()} == {"b1"}
    rng = random.Random(5)
    for n in (25, 80):
        rows = [(str(i), rng.choice([None, *[f"m{k}@x.com" for k in range(n)]]),
                 rng.choice([None, "+17025559999", *[phone(k) for k in range(n)]]), rng.choice("01"))
                for i in rng.sample(range(1, 2000), 150)]
        crm = [(k, f"m{3 * k}@x.com" if k % 2 else None, phone(2 * k) if k % 3 else None, ["vip", f"t{k}", "svc_bee"])
               for k in range(1, 9)]
        got, want = _planned(spark, rows, crm)
        assert got == want


def test_upsert_plan_of_no_customers(spark):
    raw = _raw(spark, [("-1", "-1", "a@x.com", None), ("3", "1", None, None)])
    subs = spark.createDataFrame([], "customerID string, officeID string, serviceType string, active string, serviceID string")
    crm = spark.createDataFrame([], "contact_id long, email string, phone string, tags array<string>")
    assert sorted((r["fr_id"], r["action"], r["created_by"]) for r in G.upsert_plan(raw, subs, crm).collect()) == [
        ("-1", "skipped_orphaned", None), ("3", "skipped_no_contact", None)]


class Crm:
    """A CRM that answers one attempt after the other."""

    def __init__(self, emails, phones, accepts_bare):
        self.emails, self.phones, self.accepts_bare = set(emails), set(phones), accepts_bare

    def create(self, email, phone):
        import re
        if email and not re.fullmatch(r"[^@\s]+@[^@\s]+\.[^@\s]+", email):
            return "invalid"
        if email in self.emails:
            return "email"
        if phone in self.phones:
            return "phone"
        if not (email or phone or self.accepts_bare):
            return "refused"
        self.emails |= {email} if email else set()
        self.phones |= {phone} if phone else set()
        return "ok"


def _import_one(crm, email, phone):
    """The script's retries: (action, review reason, tags)."""
    first = crm.create(email, phone)
    if first == "ok":
        return "created", None, []
    if first == "invalid":
        done = phone and crm.create(None, phone) == "ok"
        return ("created_no_email" if done else "error"), "invalid_email", ["fr_invalid_email"]
    left = {"email": email, "phone": phone, first: None}
    second = crm.create(left["email"], left["phone"])
    if second == "ok":
        return f"created_no_{first}", first, [f"fr_duplicate_{first}"]
    if second in ("email", "phone") and second != first:
        if crm.create(None, None) == "ok":
            return "created_no_email_no_phone", "email+phone", ["fr_duplicate_email", "fr_duplicate_phone"]
    return "error", "unresolved", None


def test_import_outcomes_as_one_after_the_other(spark):
    import random
    r = random.Random(7)
    mails = [None, "a@x.com", "b@x.com", "c@x.com", "bad", "d@x", "e@x.com", "f@x.com"]
    phones = [None, "+17025550001", "+17025550002", "+17025550003", "+17025550004"]
    rows = [(r.randint(1, 2), str(k), r.choice(mails), r.choice(phones)) for k in range(1, 200)]
    rows += [(1, str(1000 + k), f"m{k}@x.com", r.choice(phones)) for k in range(20)]
    rows = [x for x in rows if x[2] or x[3]]
    contacts = spark.createDataFrame(rows, "office long, fr_id string, email string, phone string").selectExpr(
        "*", "'F' AS first_name", "'L' AS last_name", "array('t') AS tags")
    existing = spark.createDataFrame([(1, "A@x.com", None), (2, None, "+17025550002")],
                                     "contact_id long, email string, phone string")
    for bare in (True, False):
        crm, want = Crm(["a@x.com"], ["+17025550002"], bare), {}
        for office, fr_id, email, phone in sorted(rows, key=lambda x: (x[0], int(x[1]))):
            want[office, fr_id] = _import_one(crm, email, phone)
        got = {(x.office, x.fr_id): x for x in G.import_outcomes(contacts, existing, bare).collect()}
        assert {k: (x.action, x.matched_on) for k, x in got.items()} == {k: v[:2] for k, v in want.items()}
        assert all(x.tags == ["t", *want[k][2]] for k, x in got.items() if want[k][2] is not None)
        seen = {v[0] for v in want.values()} | {v[1] for v in want.values()}
        assert {"created", "created_no_email", "created_no_phone", "error", "invalid_email"} <= seen
        assert ("unresolved" in seen) != bare and ("email+phone" in seen) == bare


def test_campaign_runs_take_the_next_customers(spark, tmp_path):
    from fieldlake.operators import pricing as P
    priced = spark.range(70).selectExpr("id AS subscription_id", "id div 2 AS customer_id", "60D AS old_price", "63D AS new_price")
    live, path = P.config({"safety": {"dry_run": False, "max_customers_per_run": 15}}), str(tmp_path / "ledger")
    dry = P.config({"safety": {"max_customers_per_run": 15}})
    seen = []
    for _ in range(4):
        assert {x.customer_id for x in P.campaign_run(priced, dry, path, "2024-01-01").collect()} == set(
            range(35)[15 * len(seen):15 * len(seen) + 15])
        seen.append({x.customer_id for x in P.campaign_run(priced, live, path, "2024-01-01").collect()})
    assert [len(x) for x in seen] == [15, 15, 5, 0] and set().union(*seen) == set(range(35))
    quiet = P.config({"notification": {"notify_customer": False}})
    customers = spark.sql("SELECT 1L AS customer_id, '' AS company_name, 'F' AS first_name, 'L' AS last_name, 'e' AS email")
    assert P.increase_notices(priced, customers, quiet, "2024-01-01").isEmpty()
    tagged = P.config({"notification": {"notification_method": "crm_tag"}})
    assert {x.tag for x in P.increase_notices(priced, customers, tagged, "2024-01-01").collect()} == {P.PENDING_TAG}


def test_landing_sets_broken_lines_aside(spark, tmp_path):
    from fieldlake.sources import sinks
    from fieldlake.sources.raw import land
    lines = ['{"routeID":"1","officeID":"2","date":"2024-01-01","assignedTech":"7"}', '{"routeID":"2","extra":1,"more":[1]}',
             '{"routeID":"3"', "", "  ", '[1,2]', '"text"', "null", '{"routeID":4,"assignedTech":[5]}', '{"extra":null}']
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    report = {(x.what, x.field): x.lines for x in land(spark, "route", str(tmp_path / "in"), str(tmp_path / "out")).collect()}
    assert report == {("records", None): 4, ("quarantined", None): 4, ("unknown field", "extra"): 2, ("unknown field", "more"): 1}
    assert sorted(x[0] for x in sinks.read(spark, f"{tmp_path}/out/quarantine").collect()) == sorted(
        ['{"routeID":"3"', '[1,2]', '"text"', "null"])
    rows = sinks.read(spark, f"{tmp_path}/out/records").orderBy("routeID").collect()
    assert [x.routeID for x in rows] == [None, "1", "2", "4"] and rows[3].assignedTech == "[5]"
