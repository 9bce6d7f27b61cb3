"""CRM contact operators: contact tables, service tags and the upsert plan.

The source scripts call a CRM REST API once per customer; here the same
decisions are computed for all customers at once as joins and aggregates,
producing a plan table (action, contact fields, merged tags) that a writer
can apply. Tags are ARRAY<STRING>; queries render them as sorted text.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.functions.contact import best_phone, blank_to_null, clean_email, valid_email
from fieldlake.functions.parse import strip, to_int
from fieldlake.session import ensure_checkpoint_dir

# Fixed values of the CRM tagging scheme.
OFFICE_TAGS = {1: "fr_office1", 2: "fr_office2"}
STATUS_TAGS = ("fr_active", "fr_inactive")
SERVICE_TAG_PREFIX = "svc_"
SERVICE_TAG_OFFICES = (1,)  # the other office's sync adds no service tags
BAITING_SERVICE_IDS = (1595, 225, 1363, 1384)
CUSTOMER_ID_FIELD = "FR Customer ID"


def _real(raw: DataFrame) -> Column:
    return ((F.coalesce(F.col("officeID"), F.lit("-1")) != "-1")
            & (F.coalesce(F.col("customerID"), F.lit("-1")) != "-1"))


def _of_office(raw: DataFrame, office: int) -> DataFrame:
    """The office's records; orphans carry no office and come with each."""
    return raw.filter((F.coalesce(F.col("officeID"), F.lit("-1")) == "-1") | (to_int(F.col("officeID")) == office))


def _base_fields(email: Column) -> list[Column]:
    return [
        F.col("customerID").alias("fr_id"),
        strip(F.col("fname")).alias("first_name"),
        strip(F.col("lname")).alias("last_name"),
        email.alias("email"),
        best_phone(F.col("phone1"), F.col("phone2")).alias("phone"),
        blank_to_null(F.col("companyName")).alias("company_name"),
        blank_to_null(F.col("address")).alias("address1"),
        blank_to_null(F.col("city")).alias("city"),
        blank_to_null(F.col("state")).alias("state"),
        blank_to_null(F.col("zip")).alias("postal_code"),
    ]


def _segment_tag() -> Column:
    return F.when(F.coalesce(F.col("commercialAccount"), F.lit("0")) == "1", F.lit("fr_commercial")) \
        .otherwise(F.lit("fr_residential"))


# ---------------------------------------------------------------------------
# G3–G5 — contact builds
# ---------------------------------------------------------------------------

def contacts_daily(raw_customers: DataFrame, office: int = 1) -> DataFrame:
    """Daily contact rows of one office's customers: names, optional fields
    only when non-blank, and the office / status / segment tags. ``real``
    marks records that are not orphans."""
    active = F.coalesce(F.col("active"), F.lit("0")) == "1"
    tags = F.array(F.lit(OFFICE_TAGS[office]),
                   F.when(active, F.lit("fr_active")).otherwise(F.lit("fr_inactive")), _segment_tag())
    return _of_office(raw_customers, office).select(
        *_base_fields(clean_email(F.col("email"))), tags.alias("tags"), _real(raw_customers).alias("real"))


def contacts_import(raw_customers: DataFrame, office: int | None = None,
                    field_id: str = "DRY_RUN_FIELD_ID") -> DataFrame:
    """Initial-import contact rows: active, non-orphan customers only; always
    tagged active; first email of a list; the source id as a custom field.
    ``office`` fixes the office of a single-office landing; by default each
    record's own officeID is used (the import walks every office)."""
    active = F.coalesce(F.col("active"), F.lit("0")) == "1"
    c = raw_customers.filter(active & _real(raw_customers))
    office_col = F.lit(office).cast("long") if office is not None else to_int(F.col("officeID"))
    c = c.withColumn("_office", office_col)
    tags = F.array(F.concat(F.lit("fr_office"), F.col("_office").cast("string")), F.lit("fr_active"),
                   _segment_tag())
    custom = F.array(F.struct(F.lit(field_id).alias("id"),
                              F.coalesce(F.col("customerID"), F.lit("")).alias("value")))
    return c.select(F.col("_office").alias("office"),
                    *_base_fields(clean_email(F.col("email"), first_of_list=True)),
                    tags.alias("tags"), custom.alias("custom_fields"))


def contactable(contacts: DataFrame) -> DataFrame:
    """Rows with an email or a phone (the others are skipped)."""
    return contacts.filter(F.col("email").isNotNull() | F.col("phone").isNotNull())


# ---------------------------------------------------------------------------
# G6–G8 — service tags
# ---------------------------------------------------------------------------

def sub_active(x: Column) -> Column:
    return F.lower(strip(F.coalesce(x, F.lit("0")))).isin("1", "true")


def tag_subscriptions(raw_subscriptions: DataFrame,
                      baiting_ids: Iterable[int] = BAITING_SERVICE_IDS,
                      office: int | None = None) -> DataFrame:
    """Subscriptions that feed tags: every active one, plus inactive ones
    whose service id is a rodent-baiting id; with ``office``, only its own."""
    ids = [str(i) for i in baiting_ids]
    if office is not None:
        raw_subscriptions = raw_subscriptions.filter(to_int(F.col("officeID")) == office)
    return raw_subscriptions.filter(sub_active(F.col("active")) | strip(F.col("serviceID")).isin(*ids))


# Every tag the rules can produce, in sorted order.
SERVICE_TAGS = ("svc_bedbug", "svc_bee", "svc_bird", "svc_deep_root", "svc_heater_rental",
                "svc_mosquito", "svc_pest", "svc_rodent_baiting", "svc_rodent_service", "svc_termite",
                "svc_weed")


def service_tag(service_type: Column, active: Column, normalised: bool = False) -> Column:
    """The one tag (or NULL) a subscription maps to; rules apply in order.
    With ``normalised`` the name is already trimmed and lower-cased."""
    n = service_type if normalised else F.lower(strip(service_type))
    has = lambda *ws: reduce(lambda x, y: x | y, [n.contains(w) for w in ws])
    return (F.when(n == "", None)
            .when(has("inspection", "estimate"), None)
            .when(has("rodent baiting"), F.lit("svc_rodent_baiting"))
            .when(~active, None)
            .when(n == "termite treatment", F.lit("svc_termite"))
            .when(has("mosquito"), F.lit("svc_mosquito"))
            .when(has("rodent") & has("exclusion", "trapping", "control program"), F.lit("svc_rodent_service"))
            .when(has("weed"), F.lit("svc_weed"))
            .when(has("pigeon", "flock"), F.lit("svc_bird"))
            .when(has("heater rental"), F.lit("svc_heater_rental"))
            .when(has("bed bug", "actisol"), F.lit("svc_bedbug"))
            .when(has("deep root"), F.lit("svc_deep_root"))
            .when(has("bee"), F.lit("svc_bee"))
            .when(has("pest control", "roach", "attic", "blacklight", "drain"), F.lit("svc_pest")))


def service_tags(subscriptions: DataFrame) -> DataFrame:
    """(customerID, svc_tags): the sorted set of service tags per customer.

    The tag vocabulary is fixed, so the set is aggregated as one boolean
    per tag (max) — a fixed-size partial aggregate combined map-side,
    whatever the number of subscriptions of a customer — and turned into
    the sorted array at the end.
    """
    # The name is normalised once in its own projection; no filter sits
    # between it and the aggregate (a pushed-down filter would inline the
    # normalisation into every rule). max() skips the NULL tags instead.
    n = subscriptions.select("customerID", F.lower(strip(F.col("serviceType"))).alias("_n"),
                             sub_active(F.col("active")).alias("_active"))
    t = n.select("customerID", service_tag(F.col("_n"), F.col("_active"), normalised=True).alias("tag"))
    g = t.groupBy("customerID").agg(*[F.max(F.col("tag") == tag).alias(f"_{i}")
                                      for i, tag in enumerate(SERVICE_TAGS)])
    tags = F.array(*[F.when(F.col(f"_{i}"), F.lit(tag)) for i, tag in enumerate(SERVICE_TAGS)])
    return (g.select("customerID", F.filter(tags, lambda x: x.isNotNull()).alias("svc_tags"))
            .filter(F.size("svc_tags") > 0))


def tag_counts(tags: DataFrame, contacts: DataFrame, tag_col: str = "svc_tags") -> DataFrame:
    """Of this run's ``contacts`` (real and contactable, by fr_id): customers
    per tag, plus the count of customers with svc_pest but not svc_mosquito
    (as the row 'svc_pest_not_svc_mosquito')."""
    tags = tags.join(contacts.select(F.col("fr_id").alias("customerID")), ["customerID"], "left_semi")
    per_tag = tags.select(F.explode(tag_col).alias("tag")).groupBy("tag").agg(
        F.count(F.lit(1)).alias("customers"))
    pnm = tags.agg(F.count_if(F.array_contains(tag_col, "svc_pest")
                              & ~F.array_contains(tag_col, "svc_mosquito")).alias("customers")) \
        .select(F.lit("svc_pest_not_svc_mosquito").alias("tag"), "customers")
    return per_tag.unionByName(pnm)


# ---------------------------------------------------------------------------
# G9–G11 — match, tag merge, upsert plan
# ---------------------------------------------------------------------------

def _lookup(existing: DataFrame, key: Column, name: str) -> DataFrame:
    """One row per key with the contact of lowest id holding it — de-duplicated
    before the join so a shared address cannot fan the contacts out."""
    return (existing.select(key.alias(name), F.struct("contact_id", "tags").alias("_hit"))
            .filter(F.col(name).isNotNull()).groupBy(name).agg(F.min("_hit").alias(f"{name}_hit")))


def _key(field: str) -> Column:
    """A join key that spreads the rows without a value over the partitions:
    each gets a value of its own, which no address or number equals."""
    return F.coalesce(F.col(field), F.concat(F.lit("\x00"), F.coalesce(F.col("fr_id"), F.lit(""))))


def _crm_hits(contacts: DataFrame, existing: DataFrame) -> DataFrame:
    """Adds _m_email_hit and _m_phone_hit, the CRM contacts (contact_id, tags)
    holding the row's email and its phone."""
    by_email = _lookup(existing, F.lower(F.col("email")), "_m_email")
    by_phone = _lookup(existing, F.col("phone"), "_m_phone")
    j = contacts.withColumn("_e", _key("email")).withColumn("_p", _key("phone"))
    j = (j.join(by_email, j["_e"] == by_email["_m_email"], "left")
         .join(by_phone, j["_p"] == by_phone["_m_phone"], "left"))
    return j.select(*contacts.columns, "_m_email_hit", "_m_phone_hit")


def match_contacts(contacts: DataFrame, existing: DataFrame) -> DataFrame:
    """Adds contact_id of the existing CRM contact matched by email, else by
    phone (NULL when none), and its tags as existing_tags."""
    hit = F.coalesce(F.col("_m_email_hit"), F.col("_m_phone_hit"))
    return _crm_hits(contacts, existing).select(
        *contacts.columns, hit["contact_id"].alias("contact_id"), hit["tags"].alias("existing_tags"))


def _first_holders(contacts: DataFrame) -> DataFrame:
    """Adds _f_email and _f_phone: the first row (by _ord) that carries the
    row's email and its phone, where it is an earlier one. A grouped minimum
    joined back, so a shared address never gathers in one task."""
    out = contacts
    for field in ("email", "phone"):
        first = (contacts.filter(F.col(field).isNotNull()).groupBy(F.col(field).alias(f"_k_{field}"))
                 .agg(F.min("_ord").alias(f"_first_{field}")))
        out = out.withColumn(f"_j_{field}", _key(field))
        out = out.join(first, out[f"_j_{field}"] == first[f"_k_{field}"], "left")
        out = out.withColumn(f"_f_{field}", F.when(F.col(f"_first_{field}") < F.col("_ord"), F.col(f"_first_{field}")))
    return out.select(*contacts.columns, "_f_email", "_f_phone")


def _managed(tag: Column) -> Column:
    return tag.isin(*STATUS_TAGS) | tag.startswith(SERVICE_TAG_PREFIX)


def merge_tags(existing_tags: Column, new_tags: Column) -> Column:
    """Existing tags minus the managed ones (fr_active, fr_inactive, svc_*),
    then the new tags; first occurrence kept, order preserved."""
    kept = F.filter(F.coalesce(existing_tags, F.array().cast("array<string>")), lambda t: ~_managed(t))
    return F.array_distinct(F.concat(kept, new_tags))


def upsert_actions(raw_customers: DataFrame, existing: DataFrame, office: int = 1) -> DataFrame:
    """Per changed customer of the office the action (created, updated,
    skipped_orphaned, skipped_no_contact) and where it is found: in the CRM
    (_hit) or by an earlier customer of the batch (_to; _ord is the row's own
    place). ``existing`` has contact_id, email, phone and tags (ARRAY<STRING>).

    An email is looked for before a phone, and in the CRM before the batch,
    whose contacts are in the CRM by then."""
    c = contacts_daily(raw_customers, office)
    sendable = F.col("real") & (F.col("email").isNotNull() | F.col("phone").isNotNull())
    place = F.struct(F.col("fr_id").try_cast("long").alias("n"), "fr_id", "email", "phone")
    m = _first_holders(_crm_hits(c.filter(sendable).withColumn("_ord", place), existing))
    by_email = F.col("_m_email_hit").isNotNull() | F.col("_f_email").isNotNull()
    hit = F.when(by_email, F.col("_m_email_hit")).otherwise(F.col("_m_phone_hit"))
    row = F.when(by_email, F.col("_f_email")).otherwise(F.col("_f_phone"))
    m = (m.withColumn("_hit", hit).withColumn("_to", F.when(F.col("_hit").isNull(), row))
         .drop("_m_email_hit", "_m_phone_hit", "_f_email", "_f_phone")
         .withColumn("action", F.when(F.col("_hit").isNotNull() | F.col("_to").isNotNull(), F.lit("updated"))
                     .otherwise(F.lit("created"))))
    skipped = c.filter(~sendable).withColumn(
        "action", F.when(~F.col("real"), F.lit("skipped_orphaned")).otherwise(F.lit("skipped_no_contact")))
    return m.unionByName(skipped, allowMissingColumns=True)


def _followed(links: DataFrame) -> DataFrame:
    """(_ord, _to) with ``_to`` moved on to the last row of its chain of links.
    Every round doubles the way gone, so a chain of n links takes log n rounds;
    a link leads to an earlier row, so there are no circles."""
    hops = links.filter(F.col("_to").isNotNull()).select("_ord", "_to").distinct()
    while True:
        hops = hops.checkpoint(eager=True)
        on = hops.select(F.col("_ord").alias("_at"), F.col("_to").alias("_next"))
        if hops.join(on, hops["_to"] == on["_at"], "left_semi").isEmpty():
            return hops
        hops = hops.join(on, hops["_to"] == on["_at"], "left").select(
            "_ord", F.coalesce("_next", "_to").alias("_to"))


def upsert_plan(raw_customers: DataFrame, raw_subscriptions: DataFrame, existing: DataFrame,
                office: int = 1) -> DataFrame:
    """Per changed customer of the office: the action (``upsert_actions``), the
    contact it reaches and the tags to write.

    The source sends one contact after the other, so a customer whose email or
    phone an earlier one of the batch carries reaches the contact of that
    customer, which may itself be reached through a still earlier one, and so
    on. ``same_as`` is the first customer with the address (NULL if the CRM had
    it before), ``contact_id`` the contact's id in the CRM, ``created_by`` the
    customer that created it if the CRM did not have it. Tags add up: unmanaged
    tags of the contact, then those of all earlier customers that reached it,
    then the customer's own. An address stays with the contact that had it
    first. Rows that repeat id, email and phone count as one.

    Chains are followed by doubling, and a contact's earlier tags are one
    minimum per tag, so no contact's customers have to meet in one task: a
    customer's unmanaged tags come from a fixed list."""
    ensure_checkpoint_dir(raw_customers.sparkSession)
    rows = upsert_actions(raw_customers, existing, office).checkpoint(eager=True)
    skipped = rows.filter(F.col("action").startswith("skipped")).drop("_ord", "_hit", "_to")
    send = rows.filter(~F.col("action").startswith("skipped"))
    if office in SERVICE_TAG_OFFICES:
        svc = service_tags(tag_subscriptions(raw_subscriptions, office=office))
        send = send.join(svc, send["fr_id"] == svc["customerID"], "left").drop("customerID")
    else:
        send = send.withColumn("svc_tags", F.lit(None).cast("array<string>"))
    none = F.array().cast("array<string>")

    ends = _followed(rows).select(F.col("_ord").alias("_from"), F.col("_to").alias("_end"))
    send = send.join(ends, send["_ord"] == ends["_from"], "left").drop("_from") \
        .withColumn("_end", F.coalesce("_end", "_ord"))
    known = rows.filter(F.col("_hit").isNotNull()).select(F.col("_ord").alias("_k"), F.col("_hit").alias("_known")) \
        .dropDuplicates(["_k"])
    send = send.join(known, send["_end"] == known["_k"], "left").drop("_k")
    contact = F.struct(F.col("_known.contact_id").alias("id"),
                       F.when(F.col("_known").isNull(), F.col("_end")).alias("row"))
    send = send.withColumn("_contact", contact)

    first = (send.select("_contact", "_ord", F.posexplode("tags").alias("pos", "tag")).filter(~_managed(F.col("tag")))
             .groupBy("_contact", "tag").agg(F.min(F.struct("_ord", "pos")).alias("at"))
             .groupBy(F.col("_contact").alias("_c")).agg(F.sort_array(F.collect_list(F.struct("at", "tag"))).alias("_said")))
    send = send.join(first, send["_contact"] == first["_c"], "left").drop("_c")
    before = F.transform(F.filter("_said", lambda x: x["at"]["_ord"] < F.col("_ord")), lambda x: x["tag"])
    old = F.concat(F.coalesce(F.col("_known.tags"), none), F.coalesce(before, none))
    own = F.concat("tags", F.coalesce("svc_tags", none))
    send = (send.withColumn("tags", F.when(F.col("action") == "updated", merge_tags(old, own)).otherwise(own))
            .withColumn("contact_id", F.col("_contact.id")).withColumn("created_by", F.col("_contact.row.fr_id"))
            .withColumn("same_as", F.col("_to.fr_id"))
            .drop("_ord", "_hit", "_to", "_end", "_known", "_contact", "_said"))
    return send.unionByName(skipped, allowMissingColumns=True).drop("real")


def upsert_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("customers"))


# ---------------------------------------------------------------------------
# G12–G15 — initial import
# ---------------------------------------------------------------------------

def import_pending(contacts: DataFrame, done_ids: DataFrame) -> DataFrame:
    """Drop customers already imported (``done_ids`` has fr_id)."""
    return contacts.join(done_ids.select("fr_id"), ["fr_id"], "left_anti")


def _with_duplicates(contacts: DataFrame, existing: DataFrame, counted: Column) -> DataFrame:
    """Adds _dup_email and _dup_phone: the field is set, counts (an email only
    where ``counted`` holds), and the CRM or an earlier row of the batch (by
    office, then numeric id) has it. The first row with a value always gets it
    into the CRM: whatever else is stripped from it, this field is not."""
    order = F.struct(F.col("office"), F.col("fr_id").try_cast("long"), F.col("fr_id"))
    out = contacts.withColumn("_ord", order).withColumn("_use_email", F.when(counted, F.col("email"))) \
        .withColumn("_use_phone", F.col("phone"))
    batch = out
    for field, key in (("email", F.lower(F.col("email"))), ("phone", F.col("phone"))):
        use = f"_use_{field}"
        first = (batch.filter(F.col(use).isNotNull()).groupBy(F.col(use).alias(f"_k_{field}"))
                 .agg(F.min("_ord").alias(f"_first_{field}")))
        crm = (existing.select(key.alias(f"_c_{field}")).filter(F.col(f"_c_{field}").isNotNull())
               .distinct().withColumn(f"_in_crm_{field}", F.lit(True)))
        out = (out.join(first, out[use] == first[f"_k_{field}"], "left")
               .join(crm, out[use] == crm[f"_c_{field}"], "left"))
        out = out.withColumn(f"_dup_{field}", F.col(use).isNotNull() & (
            F.coalesce(F.col(f"_in_crm_{field}"), F.lit(False)) | (F.col("_ord") != F.col(f"_first_{field}"))))
        out = out.drop(f"_k_{field}", f"_first_{field}", f"_c_{field}", f"_in_crm_{field}", use)
    return out


def import_dedupe(contacts: DataFrame, existing: DataFrame) -> DataFrame:
    """Create actions of the initial import, decided in one pass, for emails
    that are all well-formed (else see ``import_outcomes``).

    The CRM rejects a duplicate email or phone; the script then strips the
    field, tags fr_duplicate_<field> and retries. Here a field is a
    duplicate when the CRM already has it or an earlier row of the batch
    (ordered by office, then numeric id) carries it; email clashes are
    reported before phone clashes. Actions: created, created_no_email,
    created_no_phone, created_no_email_no_phone.
    """
    return import_outcomes(contacts, existing, checks_emails=False)


def import_outcomes(contacts: DataFrame, existing: DataFrame, accepts_bare: bool = True,
                    checks_emails: bool = True) -> DataFrame:
    """What becomes of each contact of the initial import, with its retries, in
    one pass.

    The CRM looks at an attempt in this order: an email that is malformed
    (unless not ``checks_emails``), an email it has, a phone it has, and, unless
    ``accepts_bare``, a contact left with neither. The script answers

    * a malformed email: strips it, tags fr_invalid_email, writes a review row
      ``invalid_email`` and tries once more if there is a phone
      (created_no_email); a phone that is taken too ends in ``error``;
    * a taken field: strips it, tags fr_duplicate_<field> and tries again
      (created_no_<field>, review row with the field's name); if then the other
      field is taken, strips that too (created_no_email_no_phone, review row
      ``email+phone``); an attempt refused without a field's name ends it
      (``error``, review row ``unresolved``).

    Columns: the contact, its original email and phone, action, and matched_on
    (the reason on the review row, NULL for none).
    """
    bad = F.col("email").isNotNull() & ~valid_email(F.col("email")) if checks_emails else F.lit(False)
    out = _with_duplicates(contacts.withColumn("_bad", bad), existing, ~F.col("_bad"))
    bad, de, dp = F.col("_bad"), F.col("_dup_email"), F.col("_dup_phone")
    no_email, no_phone = F.col("email").isNull() | bad | de, F.col("phone").isNull() | dp
    stuck = (de | dp) & no_email & no_phone & F.lit(not accepts_bare)
    action = (F.when(bad & (F.col("phone").isNull() | dp), F.lit("error")).when(bad, F.lit("created_no_email"))
              .when(stuck, F.lit("error")).when(de & dp, F.lit("created_no_email_no_phone"))
              .when(de, F.lit("created_no_email")).when(dp, F.lit("created_no_phone")).otherwise(F.lit("created")))
    reason = (F.when(bad, F.lit("invalid_email")).when(stuck, F.lit("unresolved")).when(de & dp, F.lit("email+phone"))
              .when(de, F.lit("email")).when(dp, F.lit("phone")))
    extra = F.filter(F.array(F.when(bad, F.lit("fr_invalid_email")), F.when(de, F.lit("fr_duplicate_email")),
                             F.when(dp & ~bad, F.lit("fr_duplicate_phone"))), lambda t: t.isNotNull())
    return out.select(
        "office", "fr_id", "first_name", "last_name", F.col("email").alias("original_email"),
        F.col("phone").alias("original_phone"), F.when(~(bad | de), F.col("email")).alias("email"),
        F.when(~dp | bad, F.col("phone")).alias("phone"), F.concat(F.col("tags"), extra).alias("tags"),
        action.alias("action"), reason.alias("matched_on"))


def flag_invalid_emails(contacts: DataFrame) -> DataFrame:
    """An email the CRM would reject as malformed is dropped and the row
    tagged fr_invalid_email; it stays creatable only with a phone."""
    bad = F.col("email").isNotNull() & ~valid_email(F.col("email"))
    return contacts.select(
        "*", bad.alias("invalid_email")).select(
        *[c for c in contacts.columns if c not in ("email", "tags")],
        F.when(~F.col("invalid_email"), F.col("email")).alias("email"),
        F.when(F.col("invalid_email"), F.concat(F.col("tags"), F.array(F.lit("fr_invalid_email"))))
        .otherwise(F.col("tags")).alias("tags"),
        F.when(F.col("invalid_email") & F.col("phone").isNotNull(), F.lit("created_no_email"))
        .when(F.col("invalid_email"), F.lit("error")).alias("invalid_action"))


def duplicate_review(deduped: DataFrame) -> DataFrame:
    """Rows for the manual duplicate review (fr_id, name, email, phone,
    matched_on, office), one per stripped contact."""
    name = F.btrim(F.concat_ws(" ", F.coalesce("first_name", F.lit("")), F.coalesce("last_name", F.lit(""))))
    return deduped.filter(F.col("matched_on").isNotNull()).select(
        "fr_id", name.alias("name"), F.coalesce("original_email", F.lit("")).alias("email"),
        F.coalesce("original_phone", F.lit("")).alias("phone"), "matched_on", "office")


def import_plan(raw_customers: DataFrame, office: int | None, existing: DataFrame, done_ids: DataFrame,
                dry_run: bool = True, accepts_bare: bool = True) -> DataFrame:
    """One row per pending customer with its import action. Dry run:
    would_create / skipped; live: the outcomes of ``import_outcomes`` / skipped."""
    pending = import_pending(contacts_import(raw_customers, office), done_ids)
    has_contact = F.col("email").isNotNull() | F.col("phone").isNotNull()
    skipped = pending.filter(~has_contact).select("office", "fr_id", F.lit("skipped").alias("action"))
    send = pending.filter(has_contact)
    if dry_run:
        acted = send.select("office", "fr_id", F.lit("would_create").alias("action"))
    else:
        acted = import_outcomes(send, existing, accepts_bare).select("office", "fr_id", "action")
    return acted.unionByName(skipped)


def import_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("customers"))
