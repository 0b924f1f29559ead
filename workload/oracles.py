"""DuckDB SQL for the registered queries, written as a chain of stages apart from the Spark code."""

import re

from caredeck.functions.lexicon import CATEGORY_SYNONYMS, TELECOM_TR
from caredeck.operators import findings, picks
from caredeck.operators.replies import TEXTS

from .queries import COUNTED
from .views import VIEWS


def month(label):
    return f"(cast(substr({label},1,4) as int)*12 + cast(right({label},2) as int))"


def norm(text):
    return (
        f"trim(regexp_replace(lower(translate(coalesce({text},''),'çÇğĞıIİöÖşŞüÜ','ccggiiioossuu')),"
        r"'[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+',' ','g'))"
    )


def quote(text):
    return "'" + text.replace("'", "''") + "'"


def r6(*names):
    return ", ".join(f"round({n.split(' ')[0]}, 6) as {n.split(' ')[-1]}" for n in names)


def hits(text, terms):
    cases = ", ".join(rf"case when regexp_matches({text}, '\b{t}\b') then '{t}' end" for t in terms)
    return f"list_filter([{cases}], lambda x: x is not null)"


def count(text, terms):
    return "(" + " + ".join(rf"len(regexp_extract_all({text}, '\b{t}\b'))" for t in terms) + ")::int"


def spaced_count(term):
    """Occurrences in a text of tokens that each have a blank on either side."""
    quoted = "' " + term.replace(" ", "  ") + " '"
    return f"(len(t) - len(replace(t, {quoted}, ''))) // len({quoted})"


def reason(array, prefix):
    return f"array_to_string(list_transform({array}, lambda x: '{prefix}:' || x), '; ')"


def listed(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


L = TELECOM_TR
STAGES = dict(VIEWS)


def lifecycle_sql(source):
    return f"""
    select a.*, m.total_revenue, m.avg_bill, m.avg_data_usage,
      case when months_active < 3 then 'short_observed_history'
           when months_since_last_spending >= 6 then 'extended_no_spending'
           when months_since_last_spending >= 2 then 'recent_no_spending'
           when inactive_gap_count > 0 and months_since_last_spending <= 1 then 'reactivated_after_gap'
           when active_month_ratio >= .95 then 'continuous_observed'
           when months_since_last_spending <= 1 and active_month_ratio >= .70 then 'active_recent_regular'
           when months_since_last_spending <= 1 then 'active_recent_irregular'
           else 'other_irregular' end lifecycle_status_v2
    from (select customer_id, min(mi) first_month_index, max(mi) last_month_index, count(*) months_active,
            max(mi)-min(mi)+1 observed_window_months, count(*)::double/(max(mi)-min(mi)+1) active_month_ratio,
            (select max({month('billing_year_month')}) from {source}) - max(mi) months_since_last_spending,
            count(*) filter (where gap > 0) inactive_gap_count, coalesce(max(gap),0) max_inactive_gap,
            coalesce(sum(gap),0)::bigint total_inner_gap_months, count(*) filter (where gap > 0) reactivation_count
          from (select *, mi - lag(mi) over (partition by customer_id order by mi) - 1 gap
                from (select distinct customer_id, {month('billing_year_month')} mi from {source})) group by 1) a
    join (select customer_id, min(billing_year_month) first_active_month, max(billing_year_month) last_active_month,
            sum(bill_amount) total_revenue, avg(bill_amount) avg_bill, avg(data_usage) avg_data_usage
          from {source} group by 1) m using (customer_id)""".replace(
        "select a.*,", "select a.*, m.first_active_month, m.last_active_month,"
    )


def profile_sql(source):
    return f"""
    select c.*, l.* exclude (customer_id), 2026 - birth_year age,
      case when 2026-birth_year <= 0 then null when 2026-birth_year <= 25 then '<=25' when 2026-birth_year <= 35 then '26-35'
        when 2026-birth_year <= 45 then '36-45' when 2026-birth_year <= 55 then '46-55' when 2026-birth_year <= 65 then '56-65'
        when 2026-birth_year <= 200 then '65+' end age_band,
      quantile_cont(total_revenue, 0.8) over () threshold,
      coalesce(total_revenue >= quantile_cont(total_revenue, 0.8) over (), false)::int high_value_customer
    from v_customer c left join {source} l using (customer_id)"""


STAGES["life"] = lifecycle_sql("v_spending")
STAGES["life_orders"] = lifecycle_sql("v_spending_orders")
STAGES["prof"] = profile_sql("life")
STAGES["prof_orders"] = profile_sql("life_orders")
STAGES["bills"] = f"""
    select s.*, {month('s.billing_year_month')} month_index, s.prev previous_bill_amount, s.roll rolling_3m_avg_bill,
      bill_amount - prev bill_change_abs, (bill_amount - prev) / nullif(prev, 0) bill_change_pct,
      coalesce((bill_amount - prev) / nullif(prev, 0) >= 0.3, false)::int bill_shock_flag,
      exists (select 1 from v_complaints c where c.customer_id = s.customer_id and c.problem_category = 'billing'
              and {month('c.billing_year_month')} = {month('s.billing_year_month')})::int same_month_billing_complaint,
      exists (select 1 from v_complaints c where c.customer_id = s.customer_id and c.problem_category = 'billing'
              and {month('c.billing_year_month')} = {month('s.billing_year_month')} + 1)::int next_month_billing_complaint,
      (not exists (select 1 from v_spending n where n.customer_id = s.customer_id and
         {month('n.billing_year_month')} - {month('s.billing_year_month')} in (1, 2)))::int no_billable_activity_next_2m
    from (select *, lag(bill_amount) over w prev, avg(bill_amount) over (w rows between 3 preceding and 1 preceding) roll
          from v_spending window w as (partition by customer_id order by billing_year_month)) s"""
STAGES["bills"] = STAGES["bills"].replace("select s.*,", "select s.* exclude (prev, roll),")
STAGES["reps"] = f"""
    select c.*, {month('billing_year_month')} month_index,
      exists (select 1 from v_complaints n where n.customer_id = c.customer_id and
        {month('n.billing_year_month')} - {month('c.billing_year_month')} = 1)::int repeat_complaint_next_1m,
      exists (select 1 from v_complaints n where n.customer_id = c.customer_id and
        {month('n.billing_year_month')} - {month('c.billing_year_month')} in (1, 2))::int repeat_complaint_next_2m
    from v_complaints c"""
B, K = listed(L.billing_categories), listed(L.technical_categories)
STAGES["sig"] = f"""
    select complaint_id, turn_count,
      (len(lg) > 0)::int has_legal_risk, (len(ch) > 0)::int has_churn_risk,
      (len(bs) > 0 or (cat in {B} and len(bc) > 0))::int has_billing_dispute,
      (len(ts) > 0 or (cat in {K} and len(tc) > 0))::int has_technical_outage,
      {reason('lg', 'keyword')} legal_signal_reason, {reason('ch', 'retention_keyword')} churn_signal_reason,
      {reason('(case when len(bs) > 0 then bs else bc end)', 'billing_keyword')}
        || case when cat in {B} and len(bc) > 0 then '; category_guard' else '' end billing_signal_reason,
      {reason('(case when len(ts) > 0 then ts else tc end)', 'technical_keyword')}
        || case when cat in {K} and len(tc) > 0 then '; category_guard' else '' end technical_signal_reason,
      {count('cust', L.repetition)} customer_repetition_count_v3, {count('cust', L.unresolved)} unresolved_problem_count_v3,
      {count('cust', L.frustration)} customer_frustration_count_v3, {count('agent', L.clarification)} agent_clarification_count_v3,
      ({count('cust', L.frustration)} > 0)::int high_frustration_flag,
      ((cat in {B} and len(ta) > 0 and len(ba) = 0) or (cat in {K} and len(ba) > 0 and len(ta) = 0))::int potential_agent_mismatch
    from (select *, {hits('f', L.legal)} lg, {hits('f', L.churn)} ch, {hits('f', L.billing_strong)} bs,
        {hits('f', L.billing_context)} bc, {hits('f', L.technical_strong)} ts, {hits('f', L.technical_context)} tc,
        {hits('agent', L.billing_action)} ba, {hits('agent', L.tech_action)} ta
      from (select complaint_id, turn_count, lower(problem_category) cat, {norm('full_text')} f,
              {norm('customer_text')} cust, {norm('agent_text')} agent from v_complaints))"""
STAGES["fric"] = """
    select *, case when friction_score_v3 >= 5 or severe then 'high' when friction_score_v3 <= 1 then 'low' else 'medium' end friction_level_v3
    from (select *, 2*(customer_repetition_count_v3>0)::int + 2*(unresolved_problem_count_v3>0)::int
          + 3*(customer_frustration_count_v3>0)::int + 2*(agent_clarification_count_v3>0)::int
          + 3*potential_agent_mismatch + long_conversation_flag_v3 + 2*very_long_conversation_flag_v3 friction_score_v3,
          customer_frustration_count_v3>0 and (customer_repetition_count_v3>0 or unresolved_problem_count_v3>0
            or potential_agent_mismatch=1) severe
      from (select *, (turn_count >= (select quantile_cont(turn_count::double, 0.9) from sig))::int long_conversation_flag_v3,
              (turn_count >= (select quantile_cont(turn_count::double, 0.95) from sig))::int very_long_conversation_flag_v3
            from sig))"""
STAGES["enr"] = """
    select r.* exclude (turn_count), f.* exclude (complaint_id), r.repeat_complaint_next_2m repeat_complaint,
      p.lifecycle_status_v2, p.total_revenue, p.avg_bill, p.avg_data_usage, p.high_value_customer,
      case p.high_value_customer when 1 then 'High value (top 20% revenue)' when 0 then 'Standard value' end customer_segment,
      p.months_active, p.active_month_ratio, p.months_since_last_spending, p.inactive_gap_count, p.reactivation_count,
      b.previous_bill_amount, b.rolling_3m_avg_bill, b.bill_change_abs, b.bill_change_pct,
      coalesce(b.bill_shock_flag,0) bill_shock_flag, coalesce(b.same_month_billing_complaint,0) same_month_billing_complaint,
      coalesce(b.next_month_billing_complaint,0) next_month_billing_complaint,
      coalesce(b.no_billable_activity_next_2m,0) no_billable_activity_next_2m
    from reps r join fric f using (complaint_id) left join prof p using (customer_id)
    left join bills b using (customer_id, billing_year_month)"""
PARTS = {
    "legal": "40*has_legal_risk", "churn": "30*has_churn_risk", "high_frustration": "20*high_frustration_flag",
    "high_friction": "15*(friction_level_v3='high')::int", "repeat": "15*repeat_complaint",
    "billing": "15*has_billing_dispute", "technical": "10*has_technical_outage",
    "high_value": "10*coalesce(high_value_customer,0)", "bill_shock": "10*bill_shock_flag",
}
STAGES["risk"] = f"""
    select *, case when has_legal_risk=1 or business_risk_score>=90 or (has_churn_risk=1 and friction_level_v3='high'
          and coalesce(high_value_customer,0)=1) then 'P0 Critical'
        when has_churn_risk=1 or business_risk_score > 49 then 'P1 High'
        when business_risk_score > 19 then 'P2 Medium' else 'P3 Low' end priority_level,
      case when business_risk_score<=19 then 'low' when business_risk_score<=49 then 'medium' else 'high' end business_risk_level,
      case when business_risk_score<=19 then '0-19' when business_risk_score<=39 then '20-39' when business_risk_score<=59 then '40-59'
        when business_risk_score<=79 then '60-79' else '80+' end risk_score_band
    from (select *, {' + '.join('risk_component_' + p for p in PARTS)} business_risk_score
      from (select *, {', '.join(f'{sql} risk_component_{p}' for p, sql in PARTS.items())} from enr))"""
VALUED = "coalesce(high_value_customer,0)=1"
RUNGS = (
    ("has_legal_risk=1", "Legal / Escalation / Senior Support",
     "senior escalation; legal risk review; documented callback plan"),
    ("has_technical_outage=1 and has_churn_risk=1", "Technical Support + Retention",
     "technical outage diagnosis; retention callback after technical update"),
    (f"has_billing_dispute=1 and (has_churn_risk=1 or {VALUED})", "Billing Review + Retention",
     "billing review; retention-safe explanation; proactive callback"),
    (f"has_churn_risk=1 and {VALUED}", "Retention + Senior Support",
     "retention callback; high-value customer protection review"),
    ("has_billing_dispute=1", "Billing Review", "billing review; explain relevant bill/plan items"),
    ("has_technical_outage=1", "Technical Support", "technical ticket; service quality follow-up"),
    ("friction_level_v3='high'", "Senior Agent / No-repeat Handoff",
     "conversation summary; senior agent no-repeat handoff"),
    ("potential_agent_mismatch=1", "KB-grounded Response Review",
     "KB-grounded response review; confirm customer intent before next action"),
    ("true", "Standard Support + RAG",
     "source-grounded standard support; self-service guidance if source confidence is high"),
)
CLOSE = "; cite KB document_id or use expert fallback"
STAGES["feat"] = f"""
    select *, case {' '.join(f"when {c} then '{q}'" for c, q, _ in RUNGS)} end recommended_queue,
      case {' '.join(f"when {c} then '{a}{CLOSE}'" for c, _, a in RUNGS)} end recommended_business_action from risk"""
MAXIMA = {
    "max_friction_score_v3": "friction_score_v3", "max_business_risk_score": "business_risk_score",
    "any_has_churn_risk": "has_churn_risk", "any_has_billing_dispute": "has_billing_dispute",
    "any_has_technical_outage": "has_technical_outage", "any_has_legal_risk": "has_legal_risk",
    "any_potential_agent_mismatch": "potential_agent_mismatch", "any_bill_shock_flag": "bill_shock_flag",
    "any_repeat_complaint_next_2m": "repeat_complaint_next_2m", "high_value_customer": "high_value_customer",
    "months_active": "months_active", "months_since_last_spending": "months_since_last_spending",
    "inactive_gap_count": "inactive_gap_count", "reactivation_count": "reactivation_count",
}
ROUNDED = (
    "total_revenue", "avg_bill", "avg_data_usage", "active_month_ratio", "previous_bill_amount",
    "rolling_3m_avg_bill", "bill_change_abs", "bill_change_pct",
)


def mode(column):
    return (
        f"coalesce((select v from (select {column}::varchar v, count(*) n from feat m where m.customer_id=f.customer_id and "
        f"m.billing_year_month=f.billing_year_month and {column} is not null group by 1) order by n desc, v limit 1),'unknown')"
    )


STAGES["cm"] = f"""
    select f.*, {mode('problem_category')} dominant_problem_category, {mode('problem_subcategory')} dominant_problem_subcategory,
      {mode('lifecycle_status_v2')} lifecycle_status_v2
    from (select customer_id, billing_year_month, max(month_index) month_index, count(*) complaint_count,
      count(distinct problem_category) unique_problem_category_count,
      max(case priority_level when 'P3 Low' then 1 when 'P2 Medium' then 2 when 'P1 High' then 3 else 4 end) max_priority_rank,
      {', '.join(f'max({s}) {n}' for n, s in MAXIMA.items())}, {', '.join(f'max({n}) {n}' for n in ROUNDED)},
      max(no_billable_activity_next_2m)::int no_billable_activity_next_2m from feat group by 1,2) f"""
STAGES["spl"] = """
    select cm.*, case when pos <= greatest(1, floor(n*0.6)) then 'train' when pos <= greatest(2, floor(n*0.8)) then 'validation'
      else 'test' end split
    from cm join (select month_index, row_number() over (order by month_index) pos, count(*) over () n
      from (select distinct month_index from cm where month_index <= (select max(month_index) from cm) - 2)) using (month_index)"""


# -- ranking metrics over rows (g, y, score, total_revenue, keys); g is the measured group


def topk_columns(prefix=""):
    out = []
    for p in (1, 5, 10):
        inside = f"rnk <= greatest(1, (n*{p}+99)//100)"
        prec = f"avg(y) filter (where {inside})"
        out += [
            f"round({prec}, 6) precision_top_{p}pct",
            f"round(coalesce(sum(y) filter (where {inside}) / nullif(sum(y),0)::double, 0), 6) recall_top_{p}pct",
            f"round(coalesce({prec} / nullif(avg(y),0), 0), 6) lift_top_{p}pct",
            f"round(coalesce(sum(total_revenue) filter (where y=1 and {inside}) / nullif(sum(total_revenue) filter (where y=1),0), 0), 6)"
            f" revenue_capture_top_{p}pct",
        ]
    return ", ".join(out)


def ranked_sql(source):
    return f"""select *, row_number() over (partition by g order by score desc, customer_id, billing_year_month) rnk,
      row_number() over (partition by g order by score, customer_id, billing_year_month) up, count(*) over (partition by g) n
      from {source}"""


def quality_sql(source):
    """AUC by counting pairs, average precision by the definition."""
    return f"""
    select a.g, round(auc, 6) roc_auc, round(ap, 6) average_precision_pr_auc, round(brier, 6) brier_score from
      (select p.g, avg(case when p.score > q.score then 1.0 when p.score = q.score then 0.5 else 0 end) auc
       from {source} p join {source} q on p.g = q.g and p.y = 1 and q.y = 0 group by 1) a
      join (select g, sum(pos * tp / seen) / sum(pos) ap from (select g, score, pos::double pos,
              sum(pos) over (partition by g order by score desc) tp, sum(n) over (partition by g order by score desc) seen
              from (select g, score, sum(y) pos, count(*) n from {source} group by 1,2)) group by 1) b on a.g = b.g
      join (select g, avg((score-y)**2) brier from {source} group by 1) c on a.g = c.g"""


STAGES["sc"] = "select 'all' g, * from v_scored"
STAGES["rk"] = ranked_sql("sc")
STAGES["base"] = """
    select split g, no_billable_activity_next_2m y, customer_id, billing_year_month, total_revenue,
      case when hi > lo then (s - lo) / (hi - lo) else 0 end score
    from (select *, coalesce(max_business_risk_score,0)::double s, min(coalesce(max_business_risk_score,0)::double) over (partition by split) lo,
            max(coalesce(max_business_risk_score,0)::double) over (partition by split) hi from spl where split <> 'train')"""
STAGES["base_rk"] = ranked_sql("base")

# -- retrieval

STAGES["kb"] = rf"""
    select *, {norm("title || ' ' || category || ' ' || problem || ' ' || content")} content_norm from (
    select document_id, content,
      trim(replace(coalesce(nullif(regexp_extract(content, '(?m)^#\s*(.+)$', 1), ''), document_id), '**', '')) title,
      {norm(r"replace(replace(regexp_extract(content, '(?i)Kategori\s*[:：]\s*([^\n#]+)', 1), '**', ''), '#', '')")} category,
      regexp_extract(content, '(?i)Sorun\s*[:：]\s*([^\n#]+)', 1) problem,
      regexp_extract(content, '(?is)(?:Cozum|Çözüm) Ad[ıi]mlar[ıi]\s*[:：]?\s*(.*?)(?:\n#+\s*Notlar|$)', 1) solution
    from v_reference)"""
SYNONYMS = "case {c} " + " ".join(
    f"when '{k}' then [{', '.join(quote(v) for v in (k, *words))}]" for k, words in CATEGORY_SYNONYMS.items()
) + " end"
STAGES["qs"] = f"""
    select *, {norm('query')} qn from (select *, concat_ws(' ', array_to_string({SYNONYMS.format(c='problem_category')}, ' '),
      problem_category, problem_subcategory, first_customer_message, customer_text) query from v_queries)"""


def grams(source, key, text):
    return rf"""select {key}, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i+1]))) term
      from (select {key}, regexp_extract_all({text}, '[\p{{L}}\p{{N}}_]{{2,}}') t from {source})"""


def words(source, key, text):
    return f"select * from (select {key}, unnest(string_split({text}, ' ')) term from {source}) where term <> ''"


STAGES["dtf"] = f"select document_id, term, count(*) tf from ({grams('kb', 'document_id', 'content_norm')}) group by all"
STAGES["tidf"] = "select term, ln((1 + (select count(*) from kb)) / (1.0 + count(*))) + 1 idf from dtf group by 1"
STAGES["dw"] = """
    select document_id, term, tf * idf / sqrt(sum((tf*idf)**2) over (partition by document_id)) w from dtf join tidf using (term)"""
STAGES["qw"] = f"""
    select query_id, term, tf * idf / sqrt(sum((tf*idf)**2) over (partition by query_id)) w
    from (select query_id, term, count(*) tf from ({grams('qs', 'query_id', 'qn')}) group by all) join tidf using (term)"""
STAGES["cos"] = "select query_id, document_id, sum(q.w * d.w) s from qw q join dw d using (term) group by all"
STAGES["btf"] = f"select document_id, term, count(*) tf from ({words('kb', 'document_id', 'content_norm')}) group by all"
STAGES["braw"] = """
    select term, ln((select count(*) from kb) - count(*) + 0.5) - ln(count(*) + 0.5) idf from btf group by 1"""
STAGES["bw"] = """
    select document_id, term, (case when idf < 0 then 0.25 * (select avg(idf) from braw) else idf end) * tf * 2.5
      / (tf + 1.5 * (0.25 + 0.75 * dl / ((select sum(tf) from btf) / (select count(*) from kb)))) w
    from btf join braw using (term) join (select document_id, sum(tf) dl from btf group by 1) using (document_id)"""
STAGES["bm"] = f"""
    select query_id, document_id, sum(tf * w) s
    from (select query_id, term, count(*) tf from ({words('qs', 'query_id', 'qn')}) group by all) join bw using (term) group by all"""
STAGES["pairs"] = """
    select query_id, document_id, coalesce(c.s, 0) cs, coalesce(b.s, 0) bs from (select query_id, document_id from qs, kb) p
    left join cos c using (query_id, document_id) left join bm b using (query_id, document_id)"""


def topk_sql(score, source, k):
    return f"""
    select * from (select query_id, document_id, score, row_number() over (partition by query_id order by round(score, 9) desc, document_id) as rnk
      from (select query_id, document_id, {score} score from {source})) where rnk <= {k}"""


STAGES["cpairs"] = """
    select query_id, document_id, coalesce(s, 0) cs from (select query_id, document_id from qs, kb) p
    left join cos using (query_id, document_id)"""
STAGES["bpairs"] = """
    select query_id, document_id, coalesce(s, 0) bs from (select query_id, document_id from qs, kb) p
    left join bm using (query_id, document_id)"""
STAGES["top5"] = topk_sql("cs", "cpairs", 5)
STAGES["btop5"] = topk_sql("bs", "bpairs", 5)
STAGES["peaks"] = "select *, max(bs) over (partition by query_id) peak from pairs"
STAGES["htop5"] = topk_sql("case when peak > 0 then 0.5 * cs + 0.5 * bs / peak else cs end", "peaks", 5)
STAGES["rel"] = f"""
    select query_id, problem_category, problem_subcategory, document_id, score, rnk,
      (exists (select 1 from (select unnest({SYNONYMS.format(c='problem_category')}) t) where contains(hay, t))
       or contains(hay, {norm('problem_subcategory')})) rel
    from (select q.*, t.document_id, t.score, t.rnk, {norm("k.category || ' ' || k.title || ' ' || k.content")} hay
      from top5 t join qs q using (query_id) join kb k using (document_id))"""
STAGES["rel"] = STAGES["rel"].replace(
    f"exists (select 1 from (select unnest({SYNONYMS.format(c='problem_category')}) t) where contains(hay, t))",
    f"len(list_filter({SYNONYMS.format(c='problem_category')}, lambda t: contains(hay, t))) > 0",
)
STAGES["ev"] = """
    select query_id, problem_category, problem_subcategory, max(document_id) filter (where rnk=1) top1_document_id,
      max(score) filter (where rnk=1) top1_score, max((rel and rnk<=1)::int) hit_at_1, max((rel and rnk<=3)::int) hit_at_3,
      max((rel and rnk<=5)::int) hit_at_5, sum((rel and rnk<=1)::int)::double precision_at_1,
      sum((rel and rnk<=3)::int) / least(3, count(*))::double precision_at_3,
      coalesce(1.0 / min(rnk) filter (where rel), 0)::double mrr_at_5,
      sum(case when rel then 1/log2(rnk+1) else 0 end) ndcg_at_5 from rel group by 1,2,3"""
# The same chain over the knowledge base of one language, which the replies rest on.
_CHAIN = ("kb", "dtf", "tidf", "dw", "qw", "cos", "cpairs", "top5")
for _name in _CHAIN:
    STAGES[f"{_name}_en"] = re.sub(rf"\b({'|'.join(_CHAIN)}|v_reference)\b", r"\1_en", STAGES[_name])
STAGES["ans"] = """
    select q.*, list(t.document_id order by rnk) ids, max(score) filter (where rnk=1) confidence,
      list({'id': t.document_id, 'title': k.title, 'snippet': k.content} order by rnk) docs
    from qs q join (select * from top5_en where rnk <= 3) t using (query_id) join kb_en k using (document_id) group by all"""
# Every document asks the whole knowledge base; prompts and completions rest on that.
_ASKED = ("qs", "qw", "cos", "cpairs", "top5")
for _name in _ASKED:
    _sql = re.sub(rf"\b({'|'.join(_ASKED)})\b", r"\1_docs", STAGES[_name])
    STAGES[f"{_name}_docs"] = re.sub(r"\bv_queries\b", "v_document_queries", _sql)
STAGES["ans_docs"] = re.sub(r"\b(top5|kb)_en\b", r"\1", STAGES["ans"])
STAGES["ans_docs"] = re.sub(r"\b(qs|top5)\b", r"\1_docs", STAGES["ans_docs"])


def fill(template, *values):
    parts = TEXTS[template].split("%s")
    out = quote(parts[0])
    for value, tail in zip(values, parts[1:], strict=True):
        out += f" || {value} || {quote(tail)}"
    return "(" + out + ")"


# -- representative rows: each case takes an unused row, rows of new categories first


def pick_sql(i):
    case = picks.CASES[i]
    used = " union all ".join(f"select complaint_id, problem_category from pick{j}" for j in range(i)) or "select 0, '' where false"
    order = "friction_score_v3, business_risk_score, complaint_id" if case.calm_first else "-business_risk_score, complaint_id"
    return f"""
    with used(id, category) as ({used})
    select * from (select *, 0 pool from feat where {case.condition} union all select *, 1 from feat)
    where complaint_id not in (select id from used)
    order by pool, (problem_category in (select category from used))::int, {order} limit 1"""


for _i in range(len(picks.CASES)):
    STAGES[f"pick{_i}"] = pick_sql(_i)
STAGES["picked"] = " union all ".join(
    f"select *, {i} n, {quote(c.name)} case_name, {quote(c.use)} business_use_case, {str(c.calm_first).lower()} calm from pick{i}"
    for i, c in enumerate(picks.CASES)
)
STAGES["qs_p"] = f"""
    select *, {norm('query')} qn from (select complaint_id query_id, concat_ws(' ', array_to_string({SYNONYMS.format(c='problem_category')}, ' '),
      problem_category, problem_subcategory, first_customer_message, customer_text) query
      from (select complaint_id from picked) join v_complaints using (complaint_id))"""
for _name in ("qw", "cos", "cpairs", "top5"):
    STAGES[f"{_name}_p"] = re.sub(r"\b(qs|qw|cos|cpairs|top5)\b", r"\1_p", STAGES[_name])
STAGES["shown"] = """
    select t.query_id complaint_id, list(t.document_id order by rnk) ids, max(score) filter (where rnk=1) confidence,
      sum(length(k.content)) content_chars
    from top5_p t join kb k using (document_id) where rnk <= 3 group by 1"""


def share_text(value):
    return f"printf('%.1f%%', 100 * {value})"


def distribution_text(column, levels):
    """{'level': count, ...}, the most frequent first."""
    order = "case v " + " ".join(f"when {quote(v)} then {i}" for i, v in enumerate(levels)) + " end"
    entry = "chr(39) || v || chr(39) || ': ' || c"
    return f"""(select '{{' || string_agg({entry}, ', ' order by c desc, {order}) || '}}'
      from (select {column} v, count(*) c from feat where {column} in {listed(levels)} group by 1))"""


WEAK = "confidence < 0.05"
REPLY = f"case when {WEAK} then {quote(TEXTS['no_source_reply'])} else {fill('reply', 'array_to_string(ids, chr(44) || chr(32))')} end"
STAGES["rep"] = f"""
    select query_id, problem_category, {REPLY} generated_agent_reply,
      case when {WEAK} then '' else array_to_string(ids, ',') end used_document_ids, {WEAK} fallback_used,
      round(confidence, 6) retrieval_confidence, not ({WEAK}) source_groundedness_flag from ans"""
STAGES["repev"] = f"""
    select *, len(string_split({norm('generated_agent_reply')}, ' '))::int answer_length,
      fallback_used and retrieval_confidence < 0.05 low_confidence_routing from rep"""

_WORD = re.compile(r"\w+")


def with_stages(sql):
    """`sql` preceded by the stages it needs, each after those it builds on."""
    order = []

    def visit(text):
        for word in _WORD.findall(text):
            if word in STAGES and word not in order and STAGES[word] is not text:
                visit(STAGES[word])
                if word not in order:
                    order.append(word)

    visit(sql)
    if not order:
        return sql
    return "with " + ",\n".join(f"{n} as materialized ({STAGES[n]})" for n in order) + "\n" + sql


def value_counts(column, source="feat", name="complaint_count"):
    return f"select {column}, count(*) {name} from {source} where {column} is not null group by 1"


def crosstab(rows, column, levels, normalise, source="feat"):
    cell = "round(avg(({c}='{v}')::int), 6)" if normalise else "count(*) filter (where {c}='{v}')"
    cells = ", ".join(f"{cell.format(c=column, v=v)} \"{v}\"" for v in levels)
    return f"select {rows}, {cells} from {source} where {rows} is not null group by 1"


LIFE_OUT = f"""select customer_id, first_active_month, last_active_month, first_month_index, last_month_index, months_active,
    observed_window_months, months_since_last_spending, inactive_gap_count, max_inactive_gap, total_inner_gap_months,
    reactivation_count, lifecycle_status_v2, {r6('active_month_ratio', 'total_revenue', 'avg_bill', 'avg_data_usage')} from """
LEVELS = ("high", "low", "medium")
PRIORITIES = ("P0 Critical", "P1 High", "P2 Medium", "P3 Low")
SIGNALS = (
    "has_legal_risk", "has_churn_risk", "has_billing_dispute", "has_technical_outage", "potential_agent_mismatch",
    "high_frustration_flag",
)
AT_RISK = "high_value_customer=1 and business_risk_level='high'"
SIGNAL_NAMES = (
    ("legal", "has_legal_risk"), ("churn_candidate", "has_churn_risk"), ("billing_dispute", "has_billing_dispute"),
    ("technical_outage", "has_technical_outage"), ("potential_agent_mismatch", "potential_agent_mismatch"),
    ("bill_shock", "bill_shock_flag"), ("high_value", "high_value_customer"),
    ("repeat_next_2m", "repeat_complaint_next_2m"),
)
TOPK = f"select {topk_columns()} from rk"

QUERIES = {
    "lifecycle_dense": LIFE_OUT + "life",
    "lifecycle_sparse": LIFE_OUT + "life_orders",
    "lifecycle_counts": value_counts("lifecycle_status_v2", "prof_orders", "customer_count"),
    "customer_profile": f"""select customer_id, city, age, age_band, lifecycle_status_v2, high_value_customer,
        case high_value_customer when 1 then 'High value (top 20% revenue)' else 'Standard value' end customer_segment,
        {r6('total_revenue', 'threshold')} from prof_orders""",
    "monthly_kpi": """select billing_year_month, active_customers, round(total_revenue,6) total_revenue,
        round(avg_data_usage,6) avg_data_usage, round(total_revenue/active_customers,6) arpu, coalesce(n,0) complaint_count,
        round(coalesce(n,0)/active_customers*1000,6) complaints_per_1000_active_customers
        from (select billing_year_month, count(distinct customer_id) active_customers, sum(bill_amount) total_revenue,
          avg(data_usage) avg_data_usage from v_spending group by 1)
        left join (select billing_year_month, count(*) n from v_complaints group by 1) using (billing_year_month)""",
    "category_counts": value_counts("problem_category", "v_complaints"),
    "subcategory_counts": value_counts("problem_subcategory", "v_complaints"),
    "data_scale": """select (select count(*) from v_customer) customer_rows, (select count(*) from v_spending) spending_rows,
        (select count(*) from v_complaints) complaint_rows""",
    "bill_shock": f"""select customer_id, billing_year_month, month_index, bill_shock_flag, same_month_billing_complaint,
        next_month_billing_complaint, no_billable_activity_next_2m, {r6('bill_amount', 'data_usage', 'previous_bill_amount',
        'rolling_3m_avg_bill', 'bill_change_abs', 'bill_change_pct')} from bills""",
    "bill_shock_summary": """select round(avg(bill_shock_flag),6) bill_shock_rate,
        'context feature; causal claim is not made' same_month_billing_complaint_lift from bills""",
    "safe_divide": """select customer_id, billing_year_month, round(case when data_usage = 1 then 0
        else bill_amount / (data_usage - 1) end, 6) bill_per_extra_use from v_spending""",
    "month_index": f"select distinct billing_year_month, {month('billing_year_month')} month_index from v_spending_orders",
    "repeat_flags": """select complaint_id, customer_id, billing_year_month, month_index, repeat_complaint_next_1m,
        repeat_complaint_next_2m, repeat_complaint_next_2m repeat_complaint from reps""",
    "repeat_summary": """select count(*) complaint_rows, round(avg(repeat_complaint_next_1m),6) repeat_next_1m_rate,
        round(avg(repeat_complaint_next_2m),6) repeat_next_2m_rate, sum(repeat_complaint_next_1m)::bigint repeat_next_1m_rows,
        sum(repeat_complaint_next_2m)::bigint repeat_next_2m_rows from reps""",
    "repeat_by_category": """select problem_category, count(*) complaint_count,
        round(avg(repeat_complaint_next_1m),6) repeat_next_1m_rate,
        round(avg(repeat_complaint_next_2m),6) repeat_next_2m_rate from reps group by 1""",
    "flatten_conversations": """select conv_id customer_id, count(*)::int turn_count,
        count(*) filter (where c)::int customer_turn_count, count(*) filter (where not c)::int agent_turn_count,
        coalesce(string_agg(text, ' ' order by turn) filter (where c), '') customer_text,
        coalesce(string_agg(text, ' ' order by turn) filter (where not c), '') agent_text,
        string_agg(text, ' ' order by turn) full_text, coalesce(arg_min(text, turn) filter (where c), '') first_customer_message,
        coalesce(arg_max(text, turn) filter (where c), '') last_customer_message
        from (select *, lower(role) in ('customer','musteri','user') c from conversations) group by 1""",
    "normalize_text": f"""select doc_id, t text_norm, case when t = '' then 0 else len(string_split(t,' ')) end::int words
        from (select doc_id, {norm('text')} t from documents)""",
    "phrase_counts": "select kind, id, "
    + ", ".join(f"({' + '.join(spaced_count(t) for t in terms)})::int {name}" for name, terms in COUNTED.items())
    + rf""" from (select kind, id, ' ' || array_to_string(regexp_extract_all(t, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_ ]+'), '  ') || ' ' t
        from (select 'document' kind, doc_id id, {norm('text')} t from documents
              union all select 'complaint', complaint_id, {norm('full_text')} from v_complaints))""",
    "category_terms": f"""select complaint_id, array_to_string({SYNONYMS.format(c='problem_category')}, '|') terms
        from v_complaints""",
    "complaint_signals": "select * exclude (turn_count) from sig",
    "signal_distribution": " union all ".join(
        f"select '{s}' signal, sum({s})::bigint row_count, round(avg({s}),6) rate from sig" for s in SIGNALS
    ),
    "signal_by_category": f"select problem_category, {', '.join(f'round(avg({s}),6) {s}' for s in SIGNALS)} from feat group by 1",
    "friction": """select complaint_id, long_conversation_flag_v3, very_long_conversation_flag_v3, friction_score_v3,
        friction_level_v3 from fric""",
    "friction_distribution": value_counts("friction_level_v3", "fric"),
    "friction_by_category": crosstab("problem_category", "friction_level_v3", LEVELS, True),
    "friction_by_priority": crosstab("priority_level", "friction_level_v3", LEVELS, True),
    "mismatch_summary": """select sum(potential_agent_mismatch)::bigint potential_agent_mismatch_rows,
        round(avg(potential_agent_mismatch),6) potential_agent_mismatch_rate from sig""",
    "feature_table": f"""select complaint_id, customer_id, billing_year_month, lifecycle_status_v2, high_value_customer,
        customer_segment, bill_shock_flag, same_month_billing_complaint, next_month_billing_complaint,
        no_billable_activity_next_2m, repeat_complaint, friction_score_v3, friction_level_v3, business_risk_score, priority_level,
        recommended_queue, {r6('total_revenue', 'previous_bill_amount', 'rolling_3m_avg_bill', 'bill_change_abs',
        'bill_change_pct')} from feat""",
    "risk_priority": f"""select complaint_id, {', '.join('risk_component_' + p for p in PARTS)}, business_risk_score,
        business_risk_level, priority_level, risk_score_band, array_to_string(list_filter([{', '.join(
        f"case when {c}=1 then '{n}' end" for n, c in SIGNAL_NAMES)}], lambda x: x is not null), '|') risk_signals from feat""",
    "routing": "select complaint_id, recommended_queue, recommended_business_action from feat",
    "risk_level_counts": value_counts("business_risk_level"),
    "priority_counts": value_counts("priority_level"),
    "risk_band_counts": value_counts("risk_score_band"),
    "routing_distribution": value_counts("recommended_queue"),
    "risk_component_summary": " union all ".join(
        f"select '{c}' component, sum({c})::bigint total_points, count(*) filter (where {c}>0) active_rows, "
        f"round(avg(({c}>0)::int),6) active_rate from feat"
        for c in ("risk_component_" + p for p in PARTS)
    ),
    "priority_by_category": crosstab("problem_category", "priority_level", PRIORITIES, False),
    "high_value_at_risk": f"""select complaint_id, customer_id, business_risk_score, round(total_revenue,6) total_revenue
        from feat where {AT_RISK} order by business_risk_score desc, customer_id, billing_year_month, complaint_id""",
    "high_value_at_risk_summary": f"""select count(distinct customer_id) high_value_at_risk_customers,
        round(coalesce(sum(total_revenue),0),6) historical_revenue,
        round(coalesce((select sum(r) from (select customer_id, max(total_revenue) r from feat where {AT_RISK} group by 1)),0),6)
        distinct_customer_revenue from feat where {AT_RISK}""",
    "high_value_priority": value_counts("priority_level", "feat").replace("where", "where high_value_customer=1 and"),
    "high_value_revenue": """select priority_level, count(distinct customer_id) customer_count,
        round(sum(total_revenue),6) historical_revenue from feat where high_value_customer=1 group by 1""",
    "kpi_strip": f"""select (select count(*) from v_customer) customers, count(*) complaints,
        (select problem_category from feat group by 1 order by count(*) desc, 1 limit 1) largest_category,
        round(avg((friction_level_v3='high')::int),6) high_friction_rate,
        (select round(avg(bill_shock_flag),6) from bills) bill_shock_rate,
        count(*) filter (where business_risk_level='high') high_risk_complaints,
        count(*) filter (where priority_level in ('P0 Critical','P1 High')) p0_p1_complaints,
        count(distinct customer_id) filter (where {AT_RISK}) high_value_at_risk_customers,
        (select precision_top_5pct from (select {topk_columns()} from rk)) precision_top_5pct,
        (select round(avg(hit_at_3),6) from ev) hit_at_3 from feat""",
    "findings": f"""
        select topic, finding from (select count(*) n, avg((friction_level_v3='high')::int) tense, avg((business_risk_level='high')::int) high,
            count(distinct customer_id) filter (where {AT_RISK}) people,
            coalesce(sum(total_revenue) filter (where {AT_RISK}), 0) revenue from feat) t, lateral (values
          ('Konumlandırma', {quote(findings.POSITION)}),
          ('Veri ölçeği', format('{{:,}}', (select count(*) from v_customer)) || ' müşteri, ' ||
            format('{{:,}}', (select count(*) from v_spending)) || ' harcama satırı ve ' || format('{{:,}}', n) || ' şikâyet satırı işlendi.'),
          ('Şikâyet odağı', 'En büyük şikâyet kategorisi: ' ||
            (select problem_category from feat group by 1 order by count(*) desc, 1 limit 1) || '.'),
          ('Friction', 'Yüksek friction oranı ' || {share_text('tense')} || '; bu sinyal no-repeat handoff ve agent copilot için kullanılır.'),
          ('Risk ve öncelik', 'Yüksek iş riski oranı ' || {share_text('high')} || '. Priority dağılımı: ' ||
            {distribution_text('priority_level', PRIORITIES)} || '. Risk dağılımı: ' ||
            {distribution_text('business_risk_level', ('high', 'medium', 'low'))} || '.'),
          ('Bill shock', 'Bill shock oranı ' || (select {share_text('avg(bill_shock_flag)')} from bills) ||
            '. Bu sinyal bağlamsal risk göstergesidir; nedensellik iddiası yapılmaz.'),
          ('High-value koruma', 'Yüksek değerli ve yüksek riskli müşteri sayısı ' || format('{{:,}}', people) ||
            '; tarihsel gelir toplamı ' || format('{{:,.2f}}', revenue) || '.'),
          ('RAG', 'TF-IDF/BM25 uyumlu retrieval V1 hazır. Hit@3 durumu: ' || (select {share_text('avg(hit_at_3)')} from ev) || '.'),
          ('Sınırlılık', {quote(findings.LIMITS)})
        ) v(topic, finding)""",
    "picked_rows": f"""
        select case_name, case_name example_name, business_use_case,
          case pool when 0 then {quote(picks.EXACT)} else {quote(picks.FALLBACK)} end
            || case when calm and {WEAK} then '; low_rag_confidence' else '' end fallback_reason,
          customer_id, billing_year_month, lifecycle_status_v2, customer_segment, problem_category detected_category,
          problem_subcategory detected_subcategory, problem_subcategory probable_intent, null::double intent_confidence,
          friction_score_v3, friction_level_v3, business_risk_score, business_risk_level, priority_level,
          array_to_string(list_filter([{', '.join(f"case when {c}=1 then '{n}' end" for n, c in SIGNAL_NAMES)}],
            lambda x: x is not null), '|') risk_signals,
          recommended_queue, recommended_business_action, {quote(picks.WHY)} why_this_case_matters_for_retention,
          {fill('confirm', 'problem_category', 'problem_subcategory')} confirmation_prompt,
          {fill('summary', 'billing_year_month', 'problem_category', 'friction_level_v3', 'business_risk_level', 'priority_level')}
            conversation_summary,
          case when {WEAK} then {quote(TEXTS['no_source_suggestion'])} else
            {fill('suggestion', 'array_to_string(ids, chr(44) || chr(32))')} end suggested_agent_reply,
          array_to_string(ids, ',') document_ids, round(confidence, 6) top_score, content_chars::int content_chars
        from picked join shown using (complaint_id)""",
    "customer_month": f"""select * exclude ({', '.join(ROUNDED)}), {r6(*ROUNDED)} from cm""",
    "time_split": "select customer_id, billing_year_month, split from spl",
    "ranking_metrics": f"select * exclude (g) from ({quality_sql('sc')})",
    "topk_metrics": TOPK,
    "precision_at_k": " union all ".join(
        f"select {p} top_k_percent, precision_top_{p}pct \"precision\", recall_top_{p}pct recall, lift_top_{p}pct lift from ({TOPK})"
        for p in (1, 5, 10)
    ),
    "revenue_capture": " union all ".join(
        f"select {p} top_k_percent, revenue_capture_top_{p}pct revenue_capture from ({TOPK})" for p in (1, 5, 10)
    ),
    "confusion_top5": """select 'actual_' || a actual, count(*) filter (where y=a and not hit) pred_0,
        count(*) filter (where y=a and hit) pred_1 from (values (0),(1)) v(a),
        (select y, rnk <= greatest(1, (n*5+99)//100) hit from rk) group by a""",
    "decile_table": """select greatest(1, ceil(10*(rnk-1)/(n-1)))::bigint decile, count(*) customer_months,
        round(avg(y),6) target_rate, sum(y)::bigint captured_targets, round(sum(total_revenue),6) captured_revenue,
        round(avg(score),6) avg_score from rk group by 1""",
    "calibration_table": """select greatest(1, ceil(10*(up-1)/(n-1)))::bigint bucket, count(*) "rows",
        round(avg(score),6) avg_predicted_risk, round(avg(y),6) observed_rate from rk group by 1""",
    "risk_percentile": """select customer_id, round(score,6) score, round((rank() over (order by score)
        + (count(*) over (partition by score) - 1) / 2.0) / count(*) over (), 6) risk_percentile from v_scored""",
    "baseline_metrics": f"""select q.g split, q.* exclude (g), t.* exclude (g) from ({quality_sql('base')}) q
        join (select g, {topk_columns()} from base_rk group by 1) t on q.g = t.g""",
    "kb_sections": "select document_id, title, category, problem, solution, content_norm from kb",
    "query_texts": "select query_id, query from qs",
    "tfidf_topk": "select query_id, rnk::int \"rank\", document_id, round(score,6) score from top5",
    "bm25_topk": "select query_id, rnk::int \"rank\", document_id, round(score,6) score from btop5",
    "hybrid_topk": "select query_id, rnk::int \"rank\", document_id, round(score,6) score from htop5",
    "retrieval_eval": """select query_id, problem_category, problem_subcategory, top1_document_id, hit_at_1, hit_at_3, hit_at_5,
        round(top1_score,6) top1_score, round(precision_at_1,6) precision_at_1, round(precision_at_3,6) precision_at_3,
        round(mrr_at_5,6) mrr_at_5, round(ndcg_at_5,6) ndcg_at_5, round(ndcg_at_5,6) dcg_at_5 from ev""",
    "retrieval_metrics": "select "
    + ", ".join(
        f"round(avg({c}),6) {c}"
        for c in ("hit_at_1", "hit_at_3", "hit_at_5", "precision_at_1", "precision_at_3", "mrr_at_5", "ndcg_at_5")
    )
    + """, round(avg(top1_score),6) avg_top1_score, round(median(top1_score),6) median_top1_score,
        round(avg((top1_document_id <> '')::int),6) source_coverage_rate from ev""",
    "template_replies": f"""select query_id, {fill('confirm', 'problem_category', 'problem_subcategory')} confirmation_prompt,
        {fill('summary', "billing_year_month", 'problem_category', "'None'", "'None'", "'None'")} conversation_summary,
        case when {WEAK} then {quote(TEXTS['no_source_suggestion'])} else
          {fill('suggestion', 'array_to_string(ids, chr(44) || chr(32))')} end suggested_agent_reply,
        'source-grounded KB response' recommended_business_action from ans""",
    "grounded_replies": """select * exclude (problem_category), 'llm_disabled_template_fallback' llm_status from rep""",
    "prompts": f"""select query_id, 'system' role, {quote(TEXTS['system'])} content from ans_docs union all
        select query_id, 'user' role, {fill('user', 'query', "array_to_string(list_transform(docs, lambda d: "
        + fill('source', "d['id']", "d['title']", "d['snippet']") + "), chr(10) || chr(10))")} content from ans_docs""",
    "citation_guard": f"""select query_id,
        case when status = 'llm_generated' then trim(answer) else reply end generated_agent_reply,
        case when status = 'llm_generated' then array_to_string(cited, ',') when {WEAK} then '' else array_to_string(ids, ',') end
          used_document_ids, status llm_status
        from (select *, case when {WEAK} then 'template_fallback' when answer is null then
              'llm_error_template_fallback:MissingCompletion' when len(cited) = 0 then 'llm_missing_citation_fallback'
              else 'llm_generated' end status
          from (select *, list_filter(ids, lambda i: contains(answer, i)) cited from (select a.query_id, a.ids, a.confidence, {REPLY} reply,
              case when n_chars % 3 = 0 then null else ' Kaynak ' || doc_id || ': ' || source || ' ' end answer
              from ans_docs a join documents d on a.query_id = d.doc_id)))""",
    "reply_eval": "select * from repev",
    "reply_metrics": """select round(avg((used_document_ids <> '')::int),6) answer_has_source_id_rate,
        round(avg(fallback_used::int),6) fallback_rate, round(avg(answer_length),6) avg_answer_length,
        round(avg(source_groundedness_flag::int),6) grounded_response_rate,
        round(avg(low_confidence_routing::int),6) low_confidence_routing_rate from repev""",
    "reply_failures": """select * from repev where fallback_used or not source_groundedness_flag order by query_id""",
}


def oracle_queries():
    return {name: with_stages(sql) for name, sql in QUERIES.items()}
