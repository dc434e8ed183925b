"""The expected result of each query as ANSI SQL over the raw tables.

The book's tables come in as CTEs. Nested values are computed from orders and lineitem, never from
the JSON text, so they check the parse on their own.
"""

from __future__ import annotations

import re

from checks.book import BOOK
from claimlens import schemas
from claimlens.functions.text import STOP_WORDS

ORACLES: dict[str, str] = {}

# CTEs beyond the book: the nested values, the narratives, the notes
_EXTRA = {
    "line_counts": "select l_orderkey as k, count(*) as n from lineitem group by l_orderkey",
    "detail": """select concat('C', lpad(cast(b.k as string), 9, '0')) as claim_id,
        cast(coalesce(n, 0) as integer) as line_count, (p % 5001) / 100 as copay, p % 100 >= 85 as has_cob,
        case p % 3 when 0 then 'None' when 1 then 'Medicare' else 'Commercial' end as cob_payer,
        case p % 4 when 0 then '' when 1 then 'NCCI-PTP' when 2 then 'MUE|frequency' else 'age-gender' end as edits
        from claim_base b left join line_counts l on b.k = l.k""",
    "state_all": """select c.claim_id, c.member_id, c.provider_id, c.status, c.billed_amount, c.paid_amount,
        c.denial_reason, c.requires_manual_review = 1 as requires_manual_review,
        max(cast(e.disposition_ts as timestamp)) as last_ts, max(e.event_id) as last_event,
        max(d.cob_payer) as cob_payer
        from claims c left join disposition_events e on c.claim_id = e.claim_id join detail d on c.claim_id = d.claim_id
        group by 1, 2, 3, 4, 5, 6, 7, 8""",
    "told": """select c.claim_id, c.billed_amount, concat(c.claim_type, ' claim for ', c.pos_desc, ', CPT ', c.primary_cpt,
        ', diagnosis ', c.primary_dx, ', billed $', printf('%.2f', c.billed_amount), ', provider ',
        coalesce(nullif(p.provider_name, ''), 'unknown'), ' (', coalesce(nullif(p.specialty, ''), 'unspecified'), ').',
        case c.status when 'Denied' then concat(' Claim was DENIED: ', c.denial_reason, '. Member is likely to appeal.')
          when 'Partially Paid' then concat(' Claim PARTIALLY PAID with adjustment: ', c.denial_reason, '.')
          when 'Pending' then ' Claim is PENDING adjudication.' else ' Claim was paid.' end,
        case when d.cob_payer <> 'None' then concat(' Coordination of benefits with ', d.cob_payer, '.') else '' end)
        as narrative
        from claims c join detail d on c.claim_id = d.claim_id left join providers p on c.provider_id = p.provider_id""",
    "notes": """select t.claim_id, t.narrative, cast(e.embedding as double[]) as v
        from told t join embeddings e on t.claim_id = concat('C', lpad(cast(e.vec_id as string), 9, '0'))""",
    "near": """select claim_id, narrative, distance, row_number() over (order by distance, claim_id) as rk from (
        select claim_id, narrative, round(1 - list_dot_product(v, q) /
          (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(q, q))), 9) as distance
        from notes, (select cast(embedding as double[]) as q from embeddings where vec_id = 0) as asked)
        where distance is not null order by distance, claim_id limit 30""",
    "replies": """select claim_id, k % 5 as kind, manual_review_score as score,
        case k % 3 when 0 then 'member_notice' when 1 then 'appeal_route' else 'none' end as action
        from claim_review_priority, (select 1) join claim_base
        on claim_id = concat('C', lpad(cast(k as string), 9, '0'))""",
    "newest": """select claim_id, status, ts, event_id from (
        select claim_id, disposition as status, disposition_ts as ts, event_id,
        row_number() over (partition by claim_id order by disposition_ts desc, event_id desc) as n
        from disposition_updates) where n = 1""",
}


# A word here: letters and digits of any script, with dots between them. Stated apart from the library's rule.
_WORD_LIST = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+(?:\.[\p{{L}}\p{{N}}]+)*')"


def _bm25(source: str, key: str, column: str, terms: list[str], limit: int = 30) -> dict[str, str]:
    """CTEs for keyword ranks over one text column: ``words`` and ``worded``. ``terms`` are spelled out by the caller."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    counts = ", ".join(f"len(list_filter(w, lambda x: x = '{t}')) as tf{i}" for i, t in enumerate(terms))
    found = " and ".join(f"tf{i} > 0" for i in range(len(terms)))
    figures = ", ".join(f"count(*) filter (where tf{i} > 0) as df{i}" for i in range(len(terms)))
    score = " + ".join(
        f"ln(1 + (docs - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * n / mean))"
        for i in range(len(terms))
    )
    return {
        "words": f"""select {key}, {column}, len(w) as n, {counts} from (select {key}, {column},
            list_filter({_WORD_LIST.format(column)}, lambda x: x not in ({stop})) as w from {source})""",
        "figures": f"select count(*) as docs, avg(n) as mean, {figures} from words",
        "worded": f"""select {key}, {column}, score, row_number() over (order by score desc, {key}) as rk from (
            select {key}, {column}, round({score}, 6) as score from words, figures where {found})
            order by score desc, {key} limit {limit}""",
    }


def _book_cte(name: str) -> str:
    source, columns = BOOK[name]
    return f"select {', '.join(f'{expr} as {column}' for column, expr in columns.items())} from {source}"


def with_tables(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind the CTEs it needs, in order."""
    known = {**{n: _book_cte(n) for n in BOOK}, **_EXTRA, **(extra or {})}
    needed: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"(?:from|join|,)\s+(\w+)", text)):
            if name in known and name not in needed:
                visit(known[name])
                needed[name] = known[name]

    visit(body)
    if not needed:
        return body
    return "with " + ",\n".join(f"{n} as ({sql})" for n, sql in needed.items()) + "\n" + body


def oracle(name: str, body: str, extra: dict[str, str] | None = None) -> None:
    ORACLES[name] = with_tables(body, extra)


_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
_MONEY = "cast(sum(cast({0} as decimal(18, 2))) as double)"
_FIRED = "avg(case when downstream_action_fired then 1.0::double else 0.0::double end)"

# ---- sources and sinks ------------------------------------------------------------------------

oracle(
    "table_counts",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}"
        for t in ["members", "providers", "claims", "disposition_events", "prior_authorizations", "eligibility"]
    ),
)
for _t in ["members", "providers", "claims", "disposition_events", "prior_authorizations", "eligibility"]:
    oracle(f"{_t}_table", f"select * from {_t}")
oracle(
    "written_claims",
    """select c.*, true as has_source, true as parses, d.line_count
    from claims c join detail d on c.claim_id = d.claim_id""",
)
oracle(
    "stored_line_counts",
    """select concat('C', lpad(cast(l_orderkey as string), 9, '0')) as claim_id, count(*) as line_count,
    cast(sum(l_linenumber) as bigint) as line_numbers,
    round(cast(sum(cast(l_extendedprice as decimal(18, 2))) as double), 2) as charges,
    cast(sum(1 + l_suppkey % 3) as bigint) as units from lineitem group by l_orderkey""",
)
oracle(
    "materialized_open_dispositions", "select * from disposition_events where not downstream_action_fired"
)

# ---- metrics ----------------------------------------------------------------------------------

oracle(
    "kpi_summary",
    f"""select round({_MONEY.format('billed_amount')}) as total_billed,
    round({_MONEY.format("case when status in ('Denied', 'Pending') then billed_amount else 0 end")}) as rework_pool,
    cast(sum(requires_manual_review) as bigint) as flagged_for_review, count(*) as claims,
    (select round({_FIRED}, 3) from disposition_events) as action_fired_rate from claims""",
)
_EXPOSURE = f"""select status, count(*) as claims, round({_MONEY.format('billed_amount')}) as total_billed,
    round({_MONEY.format('paid_amount')}) as total_paid from claims group by status"""
_GAP = f"""select disposition, count(*) as dispositions, round({_FIRED}, 3) as action_fired_rate
    from disposition_events group by disposition"""
oracle("dollar_exposure", _EXPOSURE)
oracle("disposition_action_gap", _GAP)
_DENIED = _MONEY.format("case when status = 'Denied' then billed_amount else 0 end")
_PENDED = _MONEY.format("case when status = 'Pending' then billed_amount else 0 end")
oracle(
    "exposure_by_claim_type",
    f"select claim_type, round({_DENIED}) as denied_dollars, round({_PENDED}) as pended_dollars from claims group by 1",
)
oracle(
    "denial_reason_dollars",
    f"""select denial_reason, count(*) as claims, round({_MONEY.format('billed_amount')}) as billed
    from claims where denial_reason is not null group by 1""",
)
oracle("biggest_gap", f"select disposition, action_fired_rate from ({_GAP}) as g order by 2, 1 limit 1")
_ALL_MEASURES = f"""count(*) as claim_count, {_MONEY.format('billed_amount')} as billed_dollars,
    {_DENIED} as denied_dollars, {_PENDED} as pended_dollars,
    avg(case when status = 'Denied' then 1.0::double else 0.0::double end) as denial_rate,
    avg(cast(requires_manual_review as double)) as manual_review_rate"""
oracle("metric_total", f"select {_ALL_MEASURES} from claims")
oracle("metric_by_place_of_service", f"select pos_desc as place, {_ALL_MEASURES} from claims group by pos_desc")
oracle(
    "metric_by_status_and_type",
    f"select status, claim_type, {_ALL_MEASURES} from claims group by status, claim_type",
)
oracle(
    "metric_by_synonym",
    f"select denial_reason, {_ALL_MEASURES} from claims where status in ('Denied', 'Pending') group by denial_reason",
)
oracle(
    "metric_dispositions",
    f"""select disposition, action_type, count(*) as disposition_count, {_FIRED} as fired_rate
    from disposition_events group by 1, 2""",
)
oracle(
    "mean_score_by_status",
    """select status, round(avg(manual_review_score), 9) as mean_score
    from claim_review_priority p join claims c on p.claim_id = c.claim_id group by status""",
)
oracle(
    "sql_exposure",
    f"""select e.status, claims, total_billed, action_fired_rate
    from ({_EXPOSURE}) as e left join ({_GAP}) as g on e.status = g.disposition""",
)

# ---- silver and nested ------------------------------------------------------------------------

oracle(
    "claims_silver",
    """select c.claim_id, status, billed_amount, line_count, copay, edits, has_cob
    from claims c join detail d on c.claim_id = d.claim_id""",
)
_CPT_CASE = BOOK["claims"][1]["primary_cpt"].replace("(p * 13) % 8", "l_partkey % 8")
_CPT_WORDS = "case l_partkey % 8 " + " ".join(f"when {i} then '{w}'" for i, w in enumerate(schemas.CPT.values())) + " end"
_DX_CASE = BOOK["claims"][1]["primary_dx"].replace("p % 7", "l_partkey % 7")
oracle(
    "claim_lines",
    f"""select concat('C', lpad(cast(l_orderkey as string), 9, '0')) as claim_id, l_linenumber as line, {_CPT_CASE} as cpt,
    {_CPT_WORDS} as cpt_desc,
    cast(1 + l_suppkey % 3 as integer) as units, l_extendedprice as charge,
    case l_partkey % 4 when 0 then '' when 1 then '25' when 2 then '59|LT' else 'GT' end as modifiers,
    {_DX_CASE} as dx_pointers,
    case l_suppkey % 4 when 0 then '0450' when 1 then '0300' when 2 then '0510' else '0710' end as rev_code
    from lineitem""",
)
oracle("open_dispositions", "select * from disposition_events where not downstream_action_fired")
oracle(
    "cob_claims",
    "select c.claim_id, member_id, status from claims c join detail d on c.claim_id = d.claim_id where has_cob",
)
_CONTAINS = """select c.claim_id, c.member_id, c.status from claims c join claim_base b on c.claim_id = concat('C', lpad(cast(b.k as string), 9, '0'))
    where p % 4 = 2 and exists (select 1 from lineitem l where l.l_orderkey = b.k and l_partkey % 8 = 1 and l_partkey % 4 = 1)
    and exists (select 1 from lineitem l where l.l_orderkey = b.k and l_suppkey % 3 = 2)"""
oracle("contains_lines", _CONTAINS)
oracle("variant_contains_lines", _CONTAINS)
for _name in ("claims_silver", "claim_lines"):
    ORACLES[_name.replace("claims", "variant").replace("claim", "variant")] = ORACLES[_name]
_HYBRID = """select c.claim_id, member_id, status, denial_reason, billed_amount, cob_payer, line_count
    from claims c join detail d on c.claim_id = d.claim_id"""
oracle("hybrid_rows", _HYBRID)
oracle(
    "hybrid_denied_top",
    f"""{_HYBRID} where status = 'Denied' and requires_manual_review = 1
    order by billed_amount desc, c.claim_id limit 5""",
)
oracle("member_cob_claims", f"{_HYBRID} where member_id = 'M0000007' and has_cob")

# ---- governance -------------------------------------------------------------------------------

_MASKED = """'XXX-XX-' || right(member_ssn, 4) as member_ssn, left(member_name, 1) || '*** ***' as member_name,
    left(member_dob, 4) || '-XX-XX' as member_dob"""
oracle("masked_members", f"select member_id, subscriber_id, {_MASKED}, plan_type, state from members")
oracle("clear_members", "select * from members")
oracle("masked_members_sql", f"select member_id, {_MASKED} from members")
oracle(
    "mask_report",
    " union all ".join(
        f"""select '{c}' as column_name, 'phi' as data_class, count(*) as row_count,
        count(*) filter (where m.{c} not like '{like}') as unmasked from (select {_MASKED} from members) as m"""
        for c, like in [("member_ssn", "XXX-XX-%"), ("member_name", "%*** ***"), ("member_dob", "____-XX-XX")]
    ),
)
_PK = [
    ("members_pk", "members", "member_id"),
    ("providers_pk", "providers", "provider_id"),
    ("claims_pk", "claims", "claim_id"),
    ("disp_pk", "disposition_events", "event_id"),
    ("pa_pk", "prior_authorizations", "pa_id"),
]
_FK = [
    ("claims_member_fk", "claims", "member_id", "members"),
    ("claims_provider_fk", "claims", "provider_id", "providers"),
    ("disp_claim_fk", "disposition_events", "claim_id", "claims"),
    ("pa_member_fk", "prior_authorizations", "member_id", "members"),
    ("pa_provider_fk", "prior_authorizations", "provider_id", "providers"),
]
_PK_CHECKS = " union all ".join(
    f"""select '{n}' as constraint_name, '{t}' as table_name, '{c}' as column_name, count(*) as row_count,
    count(*) filter (where {c} is null) as null_keys, count({c}) - count(distinct {c}) as duplicate_keys from {t}"""
    for n, t, c in _PK
)
_FK_CHECKS = " union all ".join(
    f"""select '{n}' as constraint_name, '{t}' as table_name, '{c}' as column_name, '{parent}' as parent_table,
    count(*) as orphan_rows, count(distinct a.{c}) as orphan_keys
    from {t} as a left join {parent} as b on a.{c} = b.{c} where b.{c} is null"""
    for n, t, c, parent in _FK
)
oracle("key_checks", _PK_CHECKS)
oracle("orphan_checks", _FK_CHECKS)
oracle(
    "kept_key_checks",
    f"""select constraint_name, cast(row_count as bigint) as row_count, cast(null_keys as bigint) as null_keys,
        cast(duplicate_keys as bigint) as duplicate_keys, cast(0 as bigint) as orphan_rows, cast(0 as bigint) as orphan_keys
    from ({_PK_CHECKS})
    union all
    select constraint_name, 0, 0, 0, orphan_rows, orphan_keys from ({_FK_CHECKS})""",
)
oracle(
    "constraint_report",
    f"""select table_name, 'PRIMARY KEY' as constraint_type, constraint_name, null_keys + duplicate_keys as violations
    from ({_PK_CHECKS}) as a union all
    select table_name, 'FOREIGN KEY' as constraint_type, constraint_name, orphan_rows as violations
    from ({_FK_CHECKS}) as b""",
)
# What is said of columns and tables, stated apart from the library: (table, column): (comment, synonyms, data class, personal).
_SAID = {
    ("claims", "denial_reason"): (
        "Why the payer turned the claim down; null for claims it did not.", "adjustment reason, denial, rejection, rejection reason", None, None,
    ),
    ("claims", "billed_amount"): ("Dollars the provider asked for.", "charge, submitted amount", None, None),
    ("claims", "paid_amount"): ("Dollars the payer gave; 0 while nothing has been paid.", "reimbursement", None, None),
    ("claims", "status"): ("Where the claim stands; one of STATUSES.", None, None, None),
    ("claims", "requires_manual_review"): (
        "1 if a person had to look at the claim. The review model learns this.", "claim needing review, high-risk claim", None, None,
    ),
    ("disposition_events", "downstream_action_fired"): ("True once any follow-up of the decision was started.", None, None, None),
    ("members", "member_ssn"): (None, None, "phi", "true"),
    ("members", "member_name"): (None, None, "phi", "true"),
    ("members", "member_dob"): (None, None, "phi", "true"),
}


def _said(value: str | None) -> str:
    return "null" if value is None else "'" + value.replace("'", "''") + "'"


oracle(
    "column_inventory",
    " union all ".join(
        f"""select '{t}' as table_name, '{f.name}' as column_name, cast({_said(said[0])} as varchar) as comment,
        cast({_said(said[1])} as varchar) as synonyms, cast({_said(said[2])} as varchar) as data_class,
        cast({_said(said[3])} as varchar) as pii, count(*) as row_count, count(*) - count({f.name}) as null_count from {t}"""
        for t in ["members", "providers", "claims", "disposition_events", "prior_authorizations", "eligibility"]
        for f in schemas.TABLES[t].fields
        if f.name != "claim_detail"
        for said in [_SAID.get((t, f.name), (None, None, None, None))]
    ),
)
oracle(
    "tagged_tables",
    """select table_name, comment, tag, value, row_count from (values
      ('claims', 'The claims book; a claim is one row here, with its document as JSON text.', 'domain', 'claims'),
      ('claims', 'The claims book; a claim is one row here, with its document as JSON text.', 'certified', 'true'),
      ('disposition_events', 'What was decided on a claim, when, and if anything was done about it.', 'domain', 'claims_ops')
    ) as said(table_name, comment, tag, value)
    join (select 'claims' as t, count(*) as row_count from claims union all select 'disposition_events', count(*) from disposition_events) as n
    on n.t = said.table_name""",
)
oracle(
    "update_orphans",
    """select e.claim_id, count(*) as row_count from disposition_events e
    where not exists (select 1 from disposition_updates u where u.claim_id = e.claim_id) group by e.claim_id""",
)
oracle(
    "claims_members_providers",
    """select claim_id, status, plan_type, state, specialty, in_network from claims c
    join members m on c.member_id = m.member_id join providers p on c.provider_id = p.provider_id""",
)
oracle(
    "events_with_claims",
    """select c.claim_id, event_id, disposition, billed_amount
    from claims c left join disposition_events e on c.claim_id = e.claim_id""",
)

# ---- serving ----------------------------------------------------------------------------------

_LAST = _TS.format("last_ts") + " as last_disposition_ts"
oracle(
    "current_state",
    f"""select s.claim_id, member_id, provider_id, status, billed_amount, paid_amount, denial_reason,
    requires_manual_review, cast(null as double) as triage_score, cast(null as varchar) as triage_action, {_LAST},
    last_event as last_event_id, line_count
    from state_all s join detail d on s.claim_id = d.claim_id order by billed_amount desc, s.claim_id limit 500""",
)
oracle(
    "current_state_all",
    f"select claim_id, status, billed_amount, requires_manual_review, {_LAST}, last_event as last_event_id, cob_payer from state_all",
)
oracle(
    "insert_if_absent",
    f"""select s.claim_id, status, billed_amount, case when t.claim_id is not null then 'kept' end as triage_action, {_LAST}, cob_payer
    from state_all s left join
    (select claim_id from claims order by billed_amount desc, claim_id limit 500) as t on s.claim_id = t.claim_id""",
)
_NEWER = "(n.ts is not null and (s.last_ts is null or n.ts > s.last_ts or (n.ts = s.last_ts and n.event_id > s.last_event)))"
_LATEST_STATE = f"""select coalesce(s.claim_id, n.claim_id) as claim_id, member_id,
    case when {_NEWER} then n.status else s.status end as status,
    {_TS.format(f'case when {_NEWER} then n.ts else s.last_ts end')} as last_disposition_ts,
    case when {_NEWER} then n.event_id else s.last_event end as last_event_id, cob_payer
    from state_all s full join newest n on s.claim_id = n.claim_id"""
oracle("latest_state", _LATEST_STATE)
_NEWEST = f"select claim_id, status, {_TS.format('ts')} as last_disposition_ts, event_id as last_event_id from newest"
oracle("latest_updates", _NEWEST)
oracle(
    "score_writeback",
    """select s.claim_id, status, manual_review_score as triage_score,
    case when kind in (0, 1) then action end as triage_action, cob_payer
    from state_all s join claim_review_priority p on s.claim_id = p.claim_id join replies r on s.claim_id = r.claim_id""",
)
oracle(
    "claim_dossier",
    """select c.claim_id, status, denial_reason, billed_amount, paid_amount, primary_cpt, primary_dx,
    round(manual_review_score, 3) as review_score
    from claims c join claim_review_priority p on c.claim_id = p.claim_id
    where c.claim_id in (select claim_id from disposition_updates)""",
)
oracle(
    "triage_queue",
    """select c.claim_id, round(manual_review_score, 3) as score,
    case when manual_review_score >= 0.66 then 'high' when manual_review_score >= 0.33 then 'med' else 'low' end as tier,
    status, denial_reason, billed_amount, primary_cpt
    from claim_review_priority p join claims c on p.claim_id = c.claim_id
    where status in ('Denied', 'Partially Paid', 'Pending')
    order by manual_review_score desc, c.claim_id limit 25""",
)
oracle(
    "reply_validation",
    """select claim_id, case when kind in (0, 1) then score end as triage_score,
    case when kind in (0, 1) then action end as triage_action,
    case kind when 2 then 'unknown action' when 3 then 'score out of range' when 4 then 'not json' else 'good' end
    as verdict from replies""",
)

# ---- retrieval --------------------------------------------------------------------------------

oracle("narratives", "select claim_id, narrative from told")
oracle("narratives_top", "select claim_id, narrative from told order by billed_amount desc, claim_id limit 500")
oracle(
    "vector_texts",
    """select vec_id, cast(len(embedding) as integer) as dim,
    round(sqrt(list_dot_product(cast(embedding as double[]), cast(embedding as double[]))), 4) as length
    from embeddings""",
)
oracle("vector_top30", "select claim_id, distance, cast(rk as integer) as rk from near")
_SEARCH_TERMS = ["denied", "medically", "necessary"]
_RANKED = "select claim_id, score, cast(rk as integer) as rk from worded"
oracle("keyword_top30", _RANKED, _bm25("told", "claim_id", "narrative", _SEARCH_TERMS))
oracle("keyword_scan_top30", _RANKED, _bm25("told", "claim_id", "narrative", _SEARCH_TERMS))
_CODES = {"CPT 99213": ["cpt", "99213"], "E11.9": ["e11.9"], "99214 pending": ["99214", "pending"]}
ORACLES["keyword_codes"] = " union all ".join(
    f"select '{question}' as question, claim_id, score, rk from ("
    + with_tables(_RANKED, _bm25("told", "claim_id", "narrative", terms, 10))
    + ")"
    for question, terms in _CODES.items()
)
_DOCUMENTS = "select doc_id, score, cast(rk as integer) as rk from worded"
oracle("keyword_documents", _DOCUMENTS, _bm25("documents", "doc_id", "text", ["und"]))
oracle("keyword_accents", _DOCUMENTS, _bm25("documents", "doc_id", "text", ["für"]))
# The vector of a note: counts of its words in 64 places by the first eight digits of their MD5, times the places' rarity,
# at length 1, as floats.
_STOPPED = ", ".join(f"'{w}'" for w in STOP_WORDS)
_PLACE = "cast(('0x' || substr(md5(w), 1, 8)) as bigint) % 64"
_VECTORS = {
    "note_words": f"""select claim_id, unnest(list_filter({_WORD_LIST.format('narrative')}, lambda x: x not in ({_STOPPED}))) as w from told""",
    "note_counts": f"select claim_id, {_PLACE} as place, count(*) as n from note_words group by 1, 2",
    "rarity": """select place, ln((any_value(t.total) + 1) / (count(*) + 1)) as weight
        from note_counts, (select count(*) as total from told) as t group by place""",
    "note_values": "select claim_id, c.place, n * weight as v from note_counts c join rarity r on c.place = r.place",
    "note_units": """select claim_id, place, cast(cast(v / l as float) as double) as v from note_values
        join (select claim_id, sqrt(sum(v * v)) as l from note_values group by claim_id) as s using (claim_id)""",
    "asked_values": f"""select place, sum(weight) as v from (select {_PLACE} as place
        from (values {', '.join(f"('{w}')" for w in _SEARCH_TERMS)}) as q(w)) as p join rarity using (place) group by place""",
    "asked_units": """select place, cast(cast(v / l as float) as double) as v
        from asked_values, (select sqrt(sum(v * v)) as l from asked_values) as s""",
    "note_near": """select claim_id, narrative, row_number() over (order by distance, claim_id) as rk from (
        select t.claim_id, narrative, round(1 - coalesce(x.dot, 0) /
          (x.l * (select sqrt(sum(v * v)) from asked_units)), 9) as distance
        from told t join (select n.claim_id, sum(n.v * coalesce(a.v, 0)) as dot, sqrt(sum(n.v * n.v)) as l
          from note_units n left join asked_units a on n.place = a.place group by n.claim_id) as x on t.claim_id = x.claim_id)
        order by distance, claim_id limit 30""",
}
oracle(
    "hybrid_search",
    """select coalesce(n.claim_id, w.claim_id) as claim_id, coalesce(n.narrative, w.narrative) as narrative,
    round(coalesce(1.0::double / (60 + n.rk), 0) + coalesce(1.0::double / (60 + w.rk), 0), 5) as rrf_score
    from note_near n full join worded w on n.claim_id = w.claim_id order by rrf_score desc, 1 limit 10""",
    {**_VECTORS, **_bm25("told", "claim_id", "narrative", _SEARCH_TERMS)},
)
oracle(
    "narrative_vectors",
    """select claim_id, cast(64 as integer) as dim, round(sqrt(sum(v * v)), 4) as length, round(max(v), 5) as largest
    from note_units group by claim_id""",
    _VECTORS,
)
oracle(
    "ann_checks",
    "select count(*) as rows_found, count(*) as exact_distances, true as good_recall from near",
)

# ---- features, streams, quality ---------------------------------------------------------------

oracle(
    "features",
    """select c.claim_id, status, coalesce(denial_reason, 'none') as denial_reason, claim_type, pos_desc, billed_amount,
    case when has_cob then 'true' else 'false' end as has_cob, requires_manual_review as label
    from claims c join detail d on c.claim_id = d.claim_id""",
)
oracle(
    "model_inputs",
    """select claim_id, cast(5 as double) as marked,
    round((billed_amount - avg(billed_amount) over ()) / stddev_samp(billed_amount) over (), 6) as amount from claims""",
)
_FOUND = "select claim_id, member_id, provider_id, status, billed_amount from claims"
oracle("claims_by_id", f"{_FOUND} where claim_id in (select claim_id from claims order by billed_amount desc, claim_id limit 25)")
oracle(
    "claims_by_provider",
    f"{_FOUND} where provider_id in (select provider_id from providers order by provider_name, provider_id limit 15)",
)
oracle("stream_bronze", "select * from disposition_events")
oracle("stream_open", "select * from disposition_events where not downstream_action_fired")
oracle("stream_state", _LATEST_STATE)
oracle("stream_changes", _NEWEST)
oracle(
    "stream_transitions",
    f"""select n.claim_id, s.status as before, n.status, {_TS.format('n.ts')} as last_disposition_ts, n.event_id as last_event_id
    from newest n left join state_all s on s.claim_id = n.claim_id where {_NEWER}""",
)
oracle("stream_gap", _GAP)

_RULES = {
    "D1": "select abs(count(*) - (select count(*) from orders)) from claims",
    "D2": "select count(claim_id) - count(distinct claim_id) from claims",
    "D3": "select abs(count(*) - (select count(*) from customer)) from members",
    "D4": "select count(*) from claims c left join members m on c.member_id = m.member_id where m.member_id is null",
    "D5": "select count(*) from claims c left join providers p on c.provider_id = p.provider_id where p.provider_id is null",
    "D6": "select count(*) from disposition_events e left join claims c on e.claim_id = c.claim_id where c.claim_id is null",
    "D7": "select count(*) from claims c left join detail d on c.claim_id = d.claim_id where d.claim_id is null",
    "detail_parses": "select count(*) from claims c left join detail d on c.claim_id = d.claim_id where d.line_count is null",
    "D8": "select count(*) from claims where paid_amount > billed_amount",
    "D9": "select count(*) from claims where status = 'Denied' and paid_amount <> 0",
    "D10": "select count(*) from claims where status = 'Denied' and denial_reason is null",
    "D11": "select count(*) from claims where requires_manual_review not in (0, 1)",
    "D12": "select count(*) from claims where status not in ('Paid', 'Denied', 'Pending', 'Partially Paid')",
    "G1": "select abs(count(distinct n) - 10) from (values "
    + ", ".join(f"('{row[0]}')" for row in [*_PK, *_FK])
    + ") as declared(n)",
    "G2": f"select count(*) from (select {_MASKED} from members) as m where m.member_ssn not like 'XXX-XX-%'",
    "G3": f"select count(*) from (select {_MASKED} from members) as m where m.member_name not like '%*** ***'",
    "G4": f"select count(*) from (select {_MASKED} from members) as m where m.member_dob not like '____-XX-XX'",
    "V1": f"""select case when abs(sum(total_billed) - (select round({_MONEY.format('billed_amount')}) from claims)) > 4
        then 1 else 0 end from ({_EXPOSURE}) as e""",
    "V2": f"select count(*) from ({_GAP}) as g where action_fired_rate < 0 or action_fired_rate > 1",
    "V3": "select count(*) from (select denial_reason, count(*) as n from claims where denial_reason is not null group by 1) "
    "as g where denial_reason is null or n = 0",
    "P1": f"select abs(count(*) - 3) from ({_GAP}) as g",
    "I1": f"""select count(*) from ({_GAP}) as a full join (select disposition, count(*) as n,
        count(*) filter (where downstream_action_fired) as fired from disposition_events group by 1) as b
        on a.disposition = b.disposition
        where a.dispositions is distinct from b.n or abs(a.action_fired_rate - b.fired / b.n) > 0.0005""",
    # The trained scores are not in SQL: these say that no rule is broken.
    "M1": "0",
    "M2": "0",
    "M3": "0",
    "M4": "0",
    "L1": "select abs(count(*) - 500) from (select claim_id from claims order by billed_amount desc limit 500) as s",
    "L2": """select case when count(*) filter (where line_count > 0) > 0 then 0 else 1 end
        from (select claim_id from claims order by billed_amount desc, claim_id limit 500) as s
        join detail d on s.claim_id = d.claim_id""",
    "L3": """select count(*) from (select claim_id from claims order by billed_amount desc, claim_id limit 500) as s
        join detail d on s.claim_id = d.claim_id join orders on s.claim_id = concat('C', lpad(cast(o_orderkey as string), 9, '0'))
        where has_cob <> (cast(round(o_totalprice * 100) as bigint) % 100 >= 85)""",
    "I2": "select count(*) from state_all s left join claims c on s.claim_id = c.claim_id where s.status is distinct from c.status",
}
oracle(
    "quality_report",
    "select check_id, violations, violations = 0 as passed from ("
    + " union all ".join(f"select '{c}' as check_id, cast(({sql}) as bigint) as violations" for c, sql in _RULES.items())
    + ") as r",
)
# The trained scores are not in SQL: that they break no rule, and that the AUC is above its floor, is all that is said.
oracle(
    "review_score_checks",
    "select check_id, cast(0 as bigint) as violations from (values ('M1'), ('M2'), ('M3'), ('M4'), ('AUC')) as t(check_id)",
)
oracle(
    "trained_triage_checks",
    "select cast(25 as bigint) as queued, cast(0 as bigint) as paid_queued, count(*) as rows, count(*) as scored from claims",
)

oracle(
    "review_split",
    "select requires_manual_review as label, count(*) as claims, cast(floor(count(*) * 0.25 + 0.5) as bigint) as held from claims group by 1",
)
oracle(
    "review_auc",
    """select round((sum(case when label = 1 then mean_rank end) - max(p) * (max(p) + 1) / 2) / (max(p) * (max(n) - max(p))), 12) as auc
    from (
      select label, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0 as mean_rank, sum(label) over () as p, count(*) over () as n
      from (select manual_review_score as s, cast(requires_manual_review as double) as label from claim_review_priority r join claims c on r.claim_id = c.claim_id) as a
    ) as b""",
)

_KIND = "cast(substr(event_id, 2, 9) as bigint) % 11"
oracle("loaded_records", f"select * from disposition_events where {_KIND} not in (3, 5, 7)")
oracle(
    "refused_records",
    f"""select case {_KIND} when 3 then 'no record' when 5 then 'not of type: downstream_action_fired' else 'no event_id' end as reason,
    count(*) as records, count(*) filter (where {_KIND} = 3) as cut_off from disposition_events where {_KIND} in (3, 5, 7) group by 1""",
)

# ---- the same results by other ways -----------------------------------------------------------

for _name, _same in {
    "bucketed_latest_state": "latest_state",
    "bucketed_insert_if_absent": "insert_if_absent",
    "bucketed_score_writeback": "score_writeback",
    "bucketed_current_state": "current_state_all",
    "bucketed_mean_score": "mean_score_by_status",
    "stream_keyed_state": "stream_state",
    "tree_top30": "vector_top30",
    "keyword_blocks_top30": "keyword_top30",
    "keyword_blocks_documents": "keyword_documents",
    "partial_metric_total": "metric_total",
    "partial_metric_by_status_and_type": "metric_by_status_and_type",
    "partial_metric_by_synonym": "metric_by_synonym",
    "partial_metric_dispositions": "metric_dispositions",
}.items():
    ORACLES[_name] = ORACLES[_same]
