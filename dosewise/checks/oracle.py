"""DuckDB SQL twins of the Spark queries (correctness oracle).

The binding of the supplied tables is written here a second time, in plain
SQL, and each report query is expressed directly from the report rules
(e.g. ``count(DISTINCT ...)`` where the Spark plan uses two-level
aggregation). Nothing here runs on Spark.
"""

from __future__ import annotations

from datetime import date

from ..context import RunContext
from ..sources import binding as b


def d(x: date) -> str:
    return f"DATE '{x.isoformat()}'"


def _list(vals) -> str:
    return "[" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in vals) + "]"


def _case(expr: str, mapping: dict, default=None) -> str:
    parts = " ".join(f"WHEN {repr(k)} THEN {repr(v) if isinstance(v, str) else v}" for k, v in mapping.items())
    tail = f" ELSE {repr(default) if isinstance(default, str) else default}" if default is not None else ""
    return f"CASE {expr} {parts}{tail} END"


def sr(num: str, den: str, digits: int = 2, scale: int = 0) -> str:
    """round(num/den * 10**digits) as an exact integer, NULL if den is 0/NULL."""
    f = 10 ** scale
    p = 10 ** digits
    a = f"CAST(({num}) * {f} AS HUGEINT)"
    bb = f"CAST(({den}) * {f} AS HUGEINT)"
    q = f"((abs({a}) * {2 * p} + abs({bb})) // (abs({bb}) * 2))"
    return (f"CAST(CASE WHEN ({bb}) IS NULL OR ({bb}) = 0 OR ({a}) IS NULL THEN NULL "
            f"WHEN (({a}) < 0) <> (({bb}) < 0) THEN -{q} ELSE {q} END AS BIGINT)")


def ratio_round(num: str, den: str, digits: int = 2, scale: int = 0, when_zero: str = "0.0",
                when_null: str | None = "same") -> str:
    """Exact half-away-from-zero rounding of num/den (see semantics.ratio_round)."""
    p = 10 ** digits
    nul = when_zero if when_null == "same" else ("NULL" if when_null is None else when_null)
    return (f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 THEN CAST({when_zero} AS DOUBLE) "
            f"WHEN ({num}) IS NULL THEN CAST({nul} AS DOUBLE) "
            f"ELSE CAST({sr(num, den, digits, scale)} AS DOUBLE) / {float(p)} END)")


def upct(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) = 0 THEN 0 ELSE {sr(num, den, 2)} END)"


def binding_ctes() -> list[str]:
    species = _case("c_mktsegment", b.SPECIES_BY_SEGMENT, 5)
    fth = _case("p_type", b.FTH_TYPE_BY_PTYPE)
    noun = "split_part(p_name, ' ', 2)"
    kind = _case(noun, {k: v[0] for k, v in b.SERVICE_BY_NOUN.items()}, "general")
    info = _case(noun, {k: v[1] for k, v in b.SERVICE_BY_NOUN.items()}, "Other")
    rec = _list(b.REC_LEVELS)
    fam = (f"{_list(b.FTH_FAMILIES)}[((CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) * {b.FAMILY_STEP} "
           f"+ {b.FAMILY_OFFSET}) % {len(b.FTH_FAMILIES)}) + 1]")
    k = "c_custkey"
    return [
        f"""clinics AS (
  SELECT CAST(n_nationkey AS BIGINT) AS h_id,
         CAST(1000 + n_nationkey AS BIGINT) AS location_number,
         n_name AS clinic_name, r_name AS region_name,
         {_list(b.STATE_CODES)}[(n_nationkey % {len(b.STATE_CODES)}) + 1] AS state,
         {rec}[(n_nationkey % 4) + 1] AS dose_rec_ft_dog,
         {rec}[((n_nationkey + 1) % 4) + 1] AS dose_rec_hw_dog,
         {rec}[((n_nationkey + 2) % 4) + 1] AS dose_rec_ft_cat,
         {rec}[((n_nationkey + 3) % 4) + 1] AS dose_rec_hw_cat,
         DATE '2001-01-01' + CAST(n_nationkey * 5 AS INTEGER) AS start_date,
         'ACC' || lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS account_number
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)""",
        f"""patients AS (
  SELECT c_custkey AS patient_id, CAST(floor(c_custkey / 3) AS BIGINT) AS client_id,
         CAST(c_nationkey AS BIGINT) AS h_id, {species} AS vi_species_id,
         DATE '{b.FIRST_DOB.isoformat()}' + CAST((c_custkey * 37) % 3650 AS INTEGER) AS dob,
         c_acctbal >= 0 AS is_active, c_custkey % 17 = 0 AS is_deceased, c_name AS pet_name,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 6 END AS pms_code
  FROM customer)""",
        f"""clients AS (
  SELECT CAST(c_custkey // 3 AS BIGINT) AS client_id, CAST(c_nationkey AS BIGINT) AS h_id,
         c_name AS last_name, split_part(c_name, '#', 1) AS first_name,
         {_list(b.TITLES)}[({k} % {len(b.TITLES)}) + 1] AS title,
         CAST({k} % 997 AS VARCHAR) || ' Main St' AS address1,
         {_list(b.ADDRESS2_NOTES)}[({k} % {len(b.ADDRESS2_NOTES)}) + 1] AS address2,
         'City ' || CAST(c_nationkey AS VARCHAR) AS city,
         {_list(b.STATE_CODES)}[(c_nationkey % {len(b.STATE_CODES)}) + 1] AS state,
         lpad(CAST(({k} * 7919) % 100000 AS VARCHAR), 5, '0') || '-' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0') AS postal_code,
         '(555) ' || lpad(CAST({k} % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0') AS phone1,
         CASE WHEN {k} % 11 = 0 THEN 'client' || CAST({k} AS VARCHAR) || '.example.com'
              ELSE 'client' || CAST({k} AS VARCHAR) || '@example.com' END AS primary_email,
         c_acctbal AS balance, c_mktsegment AS segment,
         CASE WHEN {k} % 13 = 0 THEN '0' ELSE '1' END AS enabled,
         CASE WHEN {k} % 9 = 0 THEN NULL ELSE {k} % 5 END AS pms_client_code
  FROM customer WHERE c_custkey % 3 = 0)""",
        """activity AS (
  SELECT o_custkey AS patient_id, CAST(min(o_orderdate) AS DATE) AS first_active,
         CAST(max(o_orderdate) AS DATE) AS last_active
  FROM orders GROUP BY o_custkey)""",
        f"""products AS (
  SELECT p_partkey AS service_id,
         CASE WHEN {fth} IS NOT NULL THEN (CASE WHEN {fam} = 'Tritak' THEN 'Frontline Tritak' ELSE {fam} END) || ' ' || p_name
              ELSE p_name END AS product,
         CASE WHEN {fth} IS NOT NULL THEN {fam} ELSE p_brand END AS family_name,
         {fth} AS type,
         CASE WHEN {fth} IS NOT NULL THEN 'fth' WHEN p_type = '{b.NSAID_PTYPE}' THEN 'nsaid' ELSE {kind} END AS service_kind,
         CASE WHEN p_type = 'STANDARD' THEN {info} END AS product_info,
         p_size AS package_size
  FROM part)""",
        """lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         o_custkey AS patient_id, CAST(floor(o_custkey / 3) AS BIGINT) AS client_id,
         o_orderkey AS invoice_number, CAST(o_orderdate AS DATE) AS invoice_date,
         l_partkey AS service_id, CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
         CAST(ceil(l_quantity / 10) AS INTEGER) AS quantity_norm,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS cost,
         l_returnflag = 'R' AS voided
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
        """wellness AS (
  SELECT service_id, 1 AS is_wellness FROM products
  WHERE service_kind = 'vaccine' OR product_info = 'Surgery - spay' OR service_kind = 'test')""",
        f"""appointments AS (
  SELECT user_id AS patient_id, CAST(ts AS DATE) - {b.EVENT_SHIFT_DAYS} AS appointment_date FROM events WHERE event_type = '{b.APPOINTMENT_EVENT}')""",
        f"""surgeries AS (
  SELECT user_id AS patient_id, CAST(ts AS DATE) - {b.EVENT_SHIFT_DAYS} AS surgery_date,
         ts - INTERVAL {b.EVENT_SHIFT_DAYS} DAY AS surgery_ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS surgery_family,
         CAST(value AS DECIMAL(18,2)) AS cost
  FROM events WHERE event_type = '{b.SURGERY_EVENT}')""",
        f"""nsaid_sales AS (
  SELECT event_id AS lineitem_id, user_id AS patient_id, CAST(floor(user_id / 3) AS BIGINT) AS client_id,
         CAST(ts AS DATE) - {b.EVENT_SHIFT_DAYS} AS invoice_date, ts - INTERVAL {b.EVENT_SHIFT_DAYS} DAY AS invoice_ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS quantity,
         CAST(value AS DECIMAL(18,2)) AS cost, CAST(user_id % 3 + 1 AS INTEGER) AS dosage_volume,
         {_list(b.NSAID_PRODUCTS + [b.NSAID_EXTRA_PRODUCT])}[(event_id % {len(b.NSAID_PRODUCTS) + 1}) + 1] AS product,
         event_id % 13 = 0 AS voided
  FROM events WHERE event_type = '{b.NSAID_SALE_EVENT}')""",
        f"""vitals AS (
  SELECT user_id AS patient_id, json_extract_string(props, '$.k') AS weight,
         {_list(b.WEIGHT_UNITS)}[(event_id % {len(b.WEIGHT_UNITS)}) + 1] AS weight_unit,
         ts - INTERVAL {b.EVENT_SHIFT_DAYS} DAY AS visit_date, event_id AS vital_id
  FROM events WHERE event_type = '{b.VITALS_EVENT}')""",
    ]


def with_ctes(*ctes: str, final: str) -> str:
    return "WITH " + ",\n".join(binding_ctes() + list(ctes)) + "\n" + final


def run_flag(ctx: RunContext) -> int:
    return ctx.end_date.year - 1995 if ctx.update_flag is None else ctx.update_flag


# ---------------------------------------------------------------- PSR
def psr_pm_cte(ctx: RunContext, first: int = -11, last: int = 0, name: str = "pm") -> str:
    lo, hi = ctx.months_window(first, last)
    ftype = ("CASE WHEN pr.type IS NOT NULL AND l.cost <> 0 AND l.quantity_norm IS NOT NULL "
             "AND l.quantity_norm <> 0 THEN pr.type END")
    return f"""{name}_raw AS (
  SELECT p.h_id, l.patient_id, p.vi_species_id,
    sum(CASE WHEN {ftype} IN ('f','ft','fh') THEN l.quantity_norm ELSE 0 END) AS ft_doses,
    sum(CASE WHEN {ftype} IN ('h','fh') THEN l.quantity_norm ELSE 0 END) AS hw_doses,
    count(DISTINCT CASE WHEN {ftype} IN ('f','ft','fh') THEN l.invoice_date END) AS ft_visits,
    count(DISTINCT CASE WHEN {ftype} IN ('h','fh') THEN l.invoice_date END) AS hw_visits,
    sum(CASE WHEN {ftype} = 'fh' THEN l.cost * CAST(0.66 AS DECIMAL(3,2)) WHEN {ftype} IN ('f','ft') THEN l.cost ELSE 0 END) AS ft_rev,
    sum(CASE WHEN {ftype} = 'fh' THEN l.cost * CAST(0.33 AS DECIMAL(3,2)) WHEN {ftype} = 'h' THEN l.cost ELSE 0 END) AS hw_rev,
    sum(l.cost) AS total_rev,
    count(DISTINCT l.invoice_date) AS visits,
    count(w.is_wellness) AS wellness_lines,
    count(CASE WHEN pr.service_kind = 'test' THEN 1 END) AS hw_tests,
    min(l.invoice_date - p.dob) AS min_age_days
  FROM lines l
  JOIN patients p ON p.patient_id = l.patient_id
  LEFT JOIN products pr ON pr.service_id = l.service_id
  LEFT JOIN wellness w ON w.service_id = l.service_id
  WHERE l.invoice_date >= {d(lo)} AND l.invoice_date < {d(hi)}
    AND NOT l.voided AND p.vi_species_id IN (3, 7)
  GROUP BY p.h_id, l.patient_id, p.vi_species_id),
{name} AS (
  SELECT r.h_id, c.location_number, r.patient_id, r.vi_species_id,
    CASE WHEN ft_doses <= 0 OR ft_rev <= 0 THEN NULL ELSE ft_doses END AS ft_doses,
    CASE WHEN hw_doses <= 0 OR hw_rev <= 0 THEN NULL ELSE hw_doses END AS hw_doses,
    CASE WHEN ft_doses <= 0 OR ft_rev <= 0 THEN NULL ELSE ft_rev END AS ft_rev,
    CASE WHEN hw_doses <= 0 OR hw_rev <= 0 THEN NULL ELSE hw_rev END AS hw_rev,
    CASE WHEN ft_doses <= 0 OR ft_rev <= 0 THEN rec_ft
         WHEN rec_ft - ft_doses < 0 THEN 0
         WHEN rec_ft - ft_doses > rec_ft THEN rec_ft
         ELSE rec_ft - ft_doses END AS ft_opp_doses,
    CASE WHEN hw_doses <= 0 OR hw_rev <= 0 THEN rec_hw
         WHEN rec_hw - hw_doses < 0 THEN 0
         WHEN rec_hw - hw_doses > rec_hw THEN rec_hw
         ELSE rec_hw - hw_doses END AS hw_opp_doses,
    greatest(total_rev, 0) AS total_rev,
    visits,
    CASE WHEN wellness_lines > 0 THEN 1 END AS wellness_care,
    CASE WHEN min_age_days < 365 THEN 1 END AS baby,
    CASE WHEN ft_doses <= 0 OR ft_rev <= 0 THEN 0 ELSE ft_visits END AS ft_visits,
    CASE WHEN hw_doses <= 0 OR hw_rev <= 0 THEN 0 ELSE hw_visits END AS hw_visits,
    hw_tests, rec_ft, rec_hw
  FROM (SELECT r.*, c.location_number,
          CASE r.vi_species_id WHEN 3 THEN c.dose_rec_ft_dog WHEN 7 THEN c.dose_rec_ft_cat ELSE 0 END AS rec_ft,
          CASE r.vi_species_id WHEN 3 THEN c.dose_rec_hw_dog WHEN 7 THEN c.dose_rec_hw_cat ELSE 0 END AS rec_hw
        FROM {name}_raw r LEFT JOIN clinics c ON c.h_id = r.h_id) r
  LEFT JOIN clinics c ON c.h_id = r.h_id),
{name}_m AS (
  SELECT h_id, location_number, patient_id, vi_species_id,
         CASE WHEN vi_species_id = 3 THEN 'Dog' ELSE 'Cat' END AS species,
         total_rev, visits, wellness_care, baby, hw_tests,
         'Flea/Tick' AS report_name, ft_doses AS doses, ft_rev AS rev, ft_opp_doses AS opp, rec_ft AS rec, ft_visits AS mkt_visits
  FROM {name}
  UNION ALL
  SELECT h_id, location_number, patient_id, vi_species_id,
         CASE WHEN vi_species_id = 3 THEN 'Dog' ELSE 'Cat' END,
         total_rev, visits, wellness_care, baby, hw_tests,
         'Heartworm', hw_doses, hw_rev, hw_opp_doses, rec_hw, hw_visits
  FROM {name})"""


GRID_CTE = """grid AS (
  SELECT c.h_id, c.location_number, m.report_name, s.species,
    CASE WHEN m.report_name = 'Flea/Tick' AND s.species = 'Dog' THEN c.dose_rec_ft_dog
         WHEN m.report_name = 'Heartworm' AND s.species = 'Dog' THEN c.dose_rec_hw_dog
         WHEN m.report_name = 'Flea/Tick' AND s.species = 'Cat' THEN c.dose_rec_ft_cat
         ELSE c.dose_rec_hw_cat END AS dose_rec
  FROM clinics c, (VALUES ('Flea/Tick'), ('Heartworm')) m(report_name), (VALUES ('Dog'), ('Cat')) s(species))"""


def psr_patient_master(ctx: RunContext) -> str:
    return with_ctes(psr_pm_cte(ctx), final="""SELECT h_id, location_number, patient_id, vi_species_id,
  CAST(ft_doses AS BIGINT) AS ft_doses, CAST(hw_doses AS BIGINT) AS hw_doses,
  CAST(ft_rev AS DOUBLE) AS ft_rev, CAST(hw_rev AS DOUBLE) AS hw_rev,
  CAST(ft_opp_doses AS BIGINT) AS ft_opp_doses, CAST(hw_opp_doses AS BIGINT) AS hw_opp_doses,
  CAST(total_rev AS DOUBLE) AS total_rev, CAST(visits AS BIGINT) AS visits,
  CAST(wellness_care AS INTEGER) AS wellness_care, CAST(baby AS INTEGER) AS baby,
  CAST(ft_visits AS BIGINT) AS ft_visits, CAST(hw_visits AS BIGINT) AS hw_visits,
  CAST(hw_tests AS BIGINT) AS hw_tests
FROM pm""")


def psr_t14(ctx: RunContext) -> str:
    return with_ctes(psr_pm_cte(ctx), GRID_CTE, final=f"""SELECT g.h_id, g.location_number, g.report_name, g.species,
  CAST(count(CASE WHEN m.opp > 0 THEN m.patient_id END) AS BIGINT) AS non_compliant_pats,
  CAST(coalesce(sum(m.opp), 0) AS BIGINT) AS total_missed_doses,
  {ratio_round('sum(m.rev)', 'sum(m.doses)', 2, 6)} AS avg_rev_dose,
  {ratio_round('sum(m.rev) * sum(m.opp)', 'sum(m.doses)', 0, 6)} AS pot_rev,
  CAST(coalesce(round(sum(m.rev), 0), 0) AS DOUBLE) AS total_rev,
  {d(ctx.end_date)} AS end_date
FROM grid g LEFT JOIN pm_m m
  ON m.h_id = g.h_id AND m.report_name = g.report_name AND m.species = g.species AND m.wellness_care IS NOT NULL
GROUP BY g.h_id, g.location_number, g.report_name, g.species""")


W = "m.wellness_care IS NOT NULL"
JOIN_M = "LEFT JOIN pm_m m ON m.h_id = g.h_id AND m.report_name = g.report_name AND m.species = g.species"
CELLS = "g.h_id, g.location_number, g.report_name, g.species"


def _avg10() -> str:
    n = f"count(DISTINCT CASE WHEN {W} AND m.doses IS NOT NULL THEN m.patient_id END)"
    return f"(CASE WHEN {n} = 0 THEN 0 ELSE coalesce({sr(f'sum(CASE WHEN {W} THEN m.doses END)', n, 1)}, 0) END)"


def psr_t1(ctx: RunContext) -> str:
    inner = f"""SELECT {CELLS}, g.dose_rec,
    count(m.patient_id) AS num_pats,
    count(CASE WHEN m.doses > 0 THEN m.patient_id END) AS pats_prod,
    count(m.wellness_care) AS pats_well,
    count(CASE WHEN m.doses > 0 AND {W} THEN m.patient_id END) AS pats_prod_well,
    {_avg10()} AS avg10,
    count(CASE WHEN {W} AND m.doses BETWEEN 1 AND m.rec - 1 THEN m.patient_id END) AS partial_pats,
    CAST(ceil(count(CASE WHEN {W} AND m.doses BETWEEN 1 AND 5 THEN m.patient_id END) * 0.25) AS BIGINT) AS twentyfive_part_prod,
    CAST(coalesce(ceil(sum(CASE WHEN {W} AND m.doses BETWEEN 1 AND 5 THEN 6 - m.doses END) * 0.25), 0) AS BIGINT) AS twentyfive_part_prod_doses,
    CAST(ceil(count(CASE WHEN {W} AND m.doses BETWEEN 7 AND 11 THEN m.patient_id END) * 0.10) AS BIGINT) AS ten_part_prod,
    CAST(coalesce(ceil(sum(CASE WHEN {W} AND m.doses BETWEEN 7 AND 11 THEN 12 - m.doses END) * 0.10), 0) AS BIGINT) AS ten_part_prod_doses,
    count(CASE WHEN {W} AND m.opp = 0 THEN m.patient_id END) AS fully_protected_pats,
    CAST(ceil(count(CASE WHEN {W} AND m.doses = 1 THEN m.patient_id END) * 0.8) AS BIGINT) AS eighty_single_pats
  FROM grid g {JOIN_M}
  GROUP BY {CELLS}, g.dose_rec"""
    mid = f"""SELECT *, pats_well - pats_prod_well AS gap,
    {upct('partial_pats', 'pats_well')} AS pp, {upct('fully_protected_pats', 'pats_well')} AS fp
  FROM ({inner})"""
    over = "(fp + pp) > 100"
    excess = "(100 - (abs(pp) + abs(fp)))"
    final = f"""SELECT h_id, location_number, report_name, species, {d(ctx.end_date)} AS end_date,
  num_pats, pats_prod, pats_well, pats_prod_well, gap AS pats_no_prod_well,
  CAST(dose_rec AS BIGINT) AS dose_rec, avg10 / 10.0 AS avg_doses,
  coalesce({sr('gap', '10', 0)}, 0) AS ten_unpro,
  coalesce({sr('gap * avg10', '100', 0)}, 0) AS ten_unpro_doses,
  coalesce({sr('gap', '4', 0)}, 0) AS twentyfive_unpro,
  coalesce({sr('gap * avg10', '40', 0)}, 0) AS twentyfive_unpro_doses,
  partial_pats, twentyfive_part_prod, twentyfive_part_prod_doses, ten_part_prod, ten_part_prod_doses,
  fully_protected_pats, eighty_single_pats, eighty_single_pats * 2 AS eighty_single_pats_doses,
  pats_well - (fully_protected_pats + partial_pats) AS unprotected_pats,
  (CASE WHEN pp > fp AND pp > (100 - (pp + fp)) AND {over} THEN pp + {excess} ELSE pp END) / 100.0 AS partial_pats_pct,
  (CASE WHEN fp > pp AND fp > (100 - (pp + fp)) AND {over} THEN fp + {excess} ELSE fp END) / 100.0 AS fully_protected_pats_pct,
  (CASE WHEN {over} THEN (100 - (pp + fp)) - {excess} ELSE (100 - (pp + fp)) END) / 100.0 AS unprotected_pats_pct
FROM ({mid})"""
    return with_ctes(psr_pm_cte(ctx), GRID_CTE, final=final)


def _bucket(expr: str, cap: int) -> str:
    return (f"CASE WHEN {expr} >= {cap} THEN '{cap}+' WHEN {expr} IS NULL OR {expr} <= 0 THEN '0' "
            f"ELSE CAST(CAST({expr} AS BIGINT) AS VARCHAR) END")


def _labels(cap: int, zero: bool = True) -> str:
    vals = ([str(i) for i in range(0 if zero else 1, cap)] + [f"{cap}+"])
    return "(VALUES " + ", ".join(f"('{v}')" for v in vals) + ") lb(doses)"


def psr_t2(ctx: RunContext) -> str:
    agg = f"""SELECT {CELLS}, {_bucket('m.doses', 12)} AS doses,
    count(DISTINCT CASE WHEN m.doses > 0 THEN m.patient_id END) AS patients
  FROM grid g LEFT JOIN pm_m m ON m.h_id = g.h_id AND m.report_name = g.report_name AND m.species = g.species AND {W}
  GROUP BY {CELLS}, 5"""
    val = "CASE WHEN d.doses = '0' THEN NULL ELSE CAST(replace(d.doses, '+', '') AS BIGINT) END"
    final = f"""SELECT d.h_id, d.location_number, d.report_name, d.species, {d(ctx.end_date)} AS end_date,
  CAST(d.dose_rec AS BIGINT) AS dose_rec, d.doses, CAST(coalesce(a.patients, 0) AS BIGINT) AS patients,
  CAST(CASE WHEN d.dose_rec - ({val}) < 0 THEN 0 ELSE (d.dose_rec - ({val})) * coalesce(a.patients, 0) END AS BIGINT) AS missed_doses
FROM (SELECT g.*, lb.doses FROM grid g, {_labels(12)}) d
LEFT JOIN ({agg}) a ON a.h_id = d.h_id AND a.report_name = d.report_name AND a.species = d.species AND a.doses = d.doses"""
    return with_ctes(psr_pm_cte(ctx), GRID_CTE, final=final)


def psr_t3(ctx: RunContext) -> str:
    d0 = "coalesce(m.doses, 0)"
    low = f"{W} AND {d0} BETWEEN 0 AND 5"
    inner = f"""SELECT {CELLS}, g.dose_rec,
    count(m.patient_id) AS num_pats,
    count(m.wellness_care) AS num_pats_wellness,
    count(CASE WHEN m.doses > 0 AND {W} THEN m.patient_id END) AS pats_prod,
    {_avg10()} AS avg10,
    count(CASE WHEN {W} AND m.doses BETWEEN 1 AND m.rec - 1 THEN m.patient_id END) AS partial_pats,
    CAST(ceil(count(CASE WHEN {low} THEN m.patient_id END) * 0.1) AS BIGINT) AS ten_pats,
    CAST(ceil(sum(CASE WHEN {low} THEN 6 - {d0} END) * 0.1) AS BIGINT) AS ten_doses,
    CAST(ceil(count(CASE WHEN {low} THEN m.patient_id END) * 0.25) AS BIGINT) AS twentyfive_pats,
    CAST(ceil(sum(CASE WHEN {low} THEN 6 - {d0} END) * 0.25) AS BIGINT) AS twentyfive_doses,
    CAST(ceil(count(CASE WHEN {low} THEN m.patient_id END) * 0.5) AS BIGINT) AS fifty_pats,
    CAST(ceil(sum(CASE WHEN {low} THEN 6 - {d0} END) * 0.5) AS BIGINT) AS fifty_doses,
    count(CASE WHEN {W} AND m.opp = 0 THEN m.patient_id END) AS fully_protected_pats
  FROM grid g LEFT JOIN pm_m m ON m.h_id = g.h_id AND m.report_name = g.report_name AND m.species = g.species AND m.baby = 1
  GROUP BY {CELLS}, g.dose_rec"""
    Wn = "num_pats_wellness"
    final = f"""SELECT h_id, location_number, report_name, species, {d(ctx.end_date)} AS end_date,
  num_pats, pats_prod, {upct('pats_prod', Wn)} / 100.0 AS pats_prod_pct,
  {Wn} - pats_prod AS pats_no_prod,
  CASE WHEN {Wn} = 0 THEN 0.0 ELSE {sr(f'{Wn} - pats_prod', Wn, 2)} / 100.0 END AS pats_no_prod_pct,
  CAST(dose_rec AS BIGINT) AS dose_rec, avg10 / 10.0 AS avg_doses,
  partial_pats, {upct('partial_pats', Wn)} / 100.0 AS partial_pats_pct,
  ten_pats, ten_doses, twentyfive_pats, twentyfive_doses, fifty_pats, fifty_doses,
  fully_protected_pats, {upct('fully_protected_pats', Wn)} / 100.0 AS fully_protected_pats_pct,
  {Wn} - (fully_protected_pats + partial_pats) AS unprotected_pats,
  (100 - ({upct('partial_pats', Wn)} + {upct('fully_protected_pats', Wn)})) / 100.0 AS unprotected_pats_pct,
  {Wn}
FROM ({inner})"""
    return with_ctes(psr_pm_cte(ctx), GRID_CTE, final=final)


def psr_t7(ctx: RunContext) -> str:
    inner = f"""SELECT {CELLS}, g.dose_rec,
    count(m.patient_id) AS num_pats,
    count(CASE WHEN m.doses > 0 THEN m.patient_id END) AS pats_prod,
    count(CASE WHEN {W} THEN m.patient_id END) AS pats_well,
    count(CASE WHEN m.doses > 0 AND {W} THEN m.patient_id END) AS pats_prod_well,
    {_avg10()} AS avg10,
    sum(CASE WHEN {W} THEN m.rev ELSE 0 END) AS w_rev,
    sum(CASE WHEN {W} THEN m.doses ELSE 0 END) AS w_doses,
    sum(CASE WHEN {W} THEN m.rev END) AS w_rev_n,
    count(CASE WHEN {W} AND m.doses BETWEEN 1 AND m.rec - 1 THEN m.patient_id END) AS partial_pats,
    count(CASE WHEN {W} AND m.opp = 0 THEN m.patient_id END) AS protected_pats
  FROM grid g {JOIN_M}
  GROUP BY {CELLS}, g.dose_rec"""
    mid = f"""SELECT *, pats_well - pats_prod_well AS gap,
    CASE WHEN coalesce(w_doses, 0) = 0 THEN 0 ELSE coalesce({sr('w_rev', 'w_doses', 2, 6)}, 0) END AS price100
  FROM ({inner})"""
    mid2 = f"SELECT *, {sr('gap * avg10', '10', 0)} AS pot_doses, gap * dose_rec AS rec_doses FROM ({mid})"
    final = f"""SELECT h_id, location_number, report_name, species, {d(ctx.end_date)} AS end_date,
  num_pats, pats_prod, pats_well, pats_prod_well,
  {upct('pats_prod_well', 'pats_well')} / 100.0 AS pats_prod_well_pct,
  gap AS pats_no_prod_well,
  CASE WHEN pats_well = 0 THEN 0.0 ELSE {sr('gap', 'pats_well', 2)} / 100.0 END AS pats_no_prod_well_pct,
  CAST(dose_rec AS BIGINT) AS dose_rec, avg10 / 10.0 AS avg_doses, price100 / 100.0 AS avg_price_dose,
  CAST(coalesce(round(w_rev_n, 0), 0) AS DOUBLE) AS total_rev,
  pot_doses AS avg_pot_doses,
  {sr('pot_doses * price100', '100', 0)} AS avg_pot_rev,
  CAST(rec_doses AS BIGINT) AS rec_doses_pot_doses,
  {sr('rec_doses * price100', '100', 0)} AS rec_doses_pot_rev,
  partial_pats, {upct('partial_pats', 'pats_well')} / 100.0 AS partial_pats_pct,
  protected_pats AS fully_protected_pats, {upct('protected_pats', 'pats_well')} / 100.0 AS fully_protected_pats_pct,
  pats_well - (partial_pats + protected_pats) AS unprotected_pats,
  (100 - ({upct('partial_pats', 'pats_well')} + {upct('protected_pats', 'pats_well')})) / 100.0 AS unprotected_pats_pct
FROM ({mid2})"""
    return with_ctes(psr_pm_cte(ctx), GRID_CTE, final=final)


def psr_t8(ctx: RunContext) -> str:
    nprod = "((m.doses IS NULL))"
    inner = f"""SELECT {CELLS}, g.dose_rec,
    count(m.patient_id) AS num_pats,
    count(CASE WHEN m.baby IS NOT NULL THEN m.patient_id END) AS num_babies,
    sum(m.total_rev) AS sum_total_rev,
    sum(m.visits) AS total_visits,
    median(m.visits) AS median_visits,
    sum(m.rev) AS mkt_rev,
    sum(m.doses) AS sum_doses,
    sum(m.mkt_visits) AS total_market_trans,
    count(CASE WHEN {nprod} THEN m.patient_id END) AS pats_no_prod,
    count(CASE WHEN {nprod} AND m.baby = 1 THEN m.patient_id END) AS babies_no_prod,
    count(CASE WHEN m.opp = 0 THEN m.patient_id END) AS pats_compliant,
    count(CASE WHEN m.hw_tests > 0 THEN m.hw_tests END) AS num_pats_hw_test,
    count(CASE WHEN {nprod} AND m.hw_tests > 0 THEN m.hw_tests END) AS num_pats_hw_test_no_prod
  FROM grid g LEFT JOIN pm_m m ON m.h_id = g.h_id AND m.report_name = g.report_name AND m.species = g.species AND {W}
  GROUP BY {CELLS}, g.dose_rec"""
    rt = "coalesce(round(sum_total_rev, 0), 0)"
    final = f"""SELECT h_id, location_number, report_name, species, {d(ctx.end_date)} AS end_date,
  num_pats, num_babies,
  {ratio_round('sum_total_rev', 'num_pats', 2, 4)} AS avg_rev_pat,
  CAST(coalesce(total_visits, 0) AS BIGINT) AS total_visits,
  {ratio_round('sum_total_rev', 'total_visits', 2, 4)} AS avg_rev_visit,
  CAST(coalesce(round(median_visits, 0), 0) AS DOUBLE) AS median_visits,
  CAST(coalesce(round(mkt_rev, 0), 0) AS DOUBLE) AS total_market_rev,
  CAST(coalesce(sum_doses, 0) AS BIGINT) AS total_doses,
  CAST(coalesce(total_market_trans, 0) AS BIGINT) AS total_market_trans,
  {ratio_round('coalesce(sum_doses, 0)', 'coalesce(total_market_trans, 0)', 2)} AS avg_doses_trans,
  CAST(dose_rec AS BIGINT) AS dose_rec,
  {ratio_round('sum_doses', 'num_pats', 2, when_null=None)} AS avg_doses_pat,
  pats_no_prod, babies_no_prod, pats_compliant,
  {ratio_round('pats_compliant', 'num_pats', 2)} AS pct_pats_compliant,
  CASE WHEN {rt} = 0 THEN 0.0 ELSE {ratio_round('mkt_rev', rt, 2, 6, when_null=None)} END AS market_rev_pct,
  num_pats_hw_test, num_pats_hw_test_no_prod
FROM ({inner})"""
    return with_ctes(psr_pm_cte(ctx), GRID_CTE, final=final)


def psr_pm2_cte(ctx: RunContext) -> str:
    lo, hi = ctx.months_window(-11, 0)
    return f"""pm2 AS (
  SELECT p.h_id, p.vi_species_id, pr.family_name,
    CASE WHEN pr.type = 'f' THEN 'ft' ELSE pr.type END AS type,
    count(DISTINCT p.patient_id) AS patients,
    CAST(sum(l.quantity_norm) AS BIGINT) AS doses,
    sum(CASE WHEN pr.type = 'fh' THEN l.cost * CAST(0.33 AS DECIMAL(3,2)) WHEN pr.type = 'h' THEN l.cost ELSE 0 END) AS hw_rev,
    sum(CASE WHEN pr.type = 'fh' THEN l.cost * CAST(0.66 AS DECIMAL(3,2)) WHEN pr.type IN ('f','ft') THEN l.cost ELSE 0 END) AS ft_rev
  FROM lines l
  JOIN patients p ON p.patient_id = l.patient_id
  JOIN products pr ON pr.service_id = l.service_id AND pr.type IS NOT NULL
  JOIN pm ON pm.patient_id = p.patient_id AND pm.h_id = p.h_id AND pm.wellness_care IS NOT NULL
  WHERE l.invoice_date >= {d(lo)} AND l.invoice_date < {d(hi)} AND NOT l.voided
    AND p.vi_species_id IN (3, 7) AND l.cost <> 0 AND l.quantity_norm IS NOT NULL AND l.quantity_norm <> 0
  GROUP BY 1, 2, 3, 4),
pm2_m AS (
  SELECT h_id, vi_species_id, CASE WHEN vi_species_id = 3 THEN 'Dog' ELSE 'Cat' END AS species, family_name, type,
         patients, doses, 'Flea/Tick' AS report_name, ft_rev AS rev FROM pm2 WHERE doses <> 0 AND ft_rev <> 0
  UNION ALL
  SELECT h_id, vi_species_id, CASE WHEN vi_species_id = 3 THEN 'Dog' ELSE 'Cat' END, family_name, type,
         patients, doses, 'Heartworm', hw_rev FROM pm2 WHERE doses <> 0 AND hw_rev <> 0)"""


def psr_product_master(ctx: RunContext) -> str:
    return with_ctes(psr_pm_cte(ctx), psr_pm2_cte(ctx), final="""SELECT h_id, vi_species_id, family_name, type,
  patients, doses, CAST(hw_rev AS DOUBLE) AS hw_rev, CAST(ft_rev AS DOUBLE) AS ft_rev FROM pm2""")


PRIO = "('Frontline', 'Certifect', 'Heartgard', 'Tritak', 'NexGard')"
PC = "h_id, report_name, species"


def _topn(src: str, measure: str, total: str) -> str:
    """TK1 in SQL over rows (h_id, report_name, species, family_name, measure, total)."""
    r1 = f"dense_rank() OVER (PARTITION BY {PC} ORDER BY CASE WHEN family_name IN {PRIO} THEN 1 ELSE 2 END, {measure} DESC, family_name)"
    r2 = f"dense_rank() OVER (PARTITION BY {PC} ORDER BY {measure} DESC, family_name)"
    ranked = f"""SELECT {PC}, {total}, {measure},
    CASE WHEN {r1} >= 6 THEN 'Other ' || report_name ELSE family_name END AS fam,
    least({r1}, 6) AS row_order, least({r2}, 6) AS mrank FROM ({src})"""
    grouped = f"""SELECT {PC}, fam, sum({measure}) AS {measure}, any_value({total}) AS {total},
    min(row_order) AS row_order, min(mrank) AS mrank FROM ({ranked}) GROUP BY {PC}, fam"""
    return f"""SELECT *, CASE WHEN {total} = 0 THEN 0 ELSE {sr(measure, total, 2)} END AS units FROM ({grouped})"""


def _reconciled(units: str = "t.units") -> str:
    s = f"sum({units}) OVER (PARTITION BY t.h_id, t.report_name, t.species)"
    return f"(CASE WHEN t.mrank = 1 AND {s} <> 100 THEN {units} + (100 - {s}) ELSE {units} END)"


def psr_t5(ctx: RunContext) -> str:
    fam = """SELECT h_id, report_name, species, family_name, qty, total_qty FROM (
    SELECT h_id, report_name, species, family_name, sum(doses) AS qty,
           sum(sum(doses)) OVER (PARTITION BY h_id, report_name, species) AS total_qty
    FROM pm2_m GROUP BY h_id, report_name, species, family_name)"""
    fam = f"SELECT * FROM ({fam}) WHERE (CASE WHEN total_qty = 0 THEN 0 ELSE {sr('qty', 'total_qty', 2)} END) > 0"
    t = _topn(fam, "qty", "total_qty")
    final = f"""SELECT t.h_id, c.location_number, t.report_name, t.species, t.fam AS product_name, t.row_order,
  {_reconciled()} / 100.0 AS dose_pct, {d(ctx.end_date)} AS end_date
FROM ({t}) t LEFT JOIN clinics c ON c.h_id = t.h_id"""
    return with_ctes(psr_pm_cte(ctx), psr_pm2_cte(ctx), final=final)


def psr_t6(ctx: RunContext) -> str:
    t5 = psr_t5(ctx)
    body5 = t5[t5.index("SELECT t.h_id, c.location_number"):]
    final = f"""SELECT t5.h_id, t5.location_number, t5.report_name, t5.species, t5.product_name, t5.row_order,
  {ratio_round('f.qty', 'f.patients', 1)} AS doses_pat, t5.end_date
FROM ({body5}) t5
JOIN (SELECT h_id, report_name, species, family_name, sum(doses) AS qty, sum(patients) AS patients
      FROM pm2_m GROUP BY 1, 2, 3, 4) f
  ON f.h_id = t5.h_id AND f.report_name = t5.report_name AND f.species = t5.species AND f.family_name = t5.product_name
WHERE t5.row_order < 6"""
    return with_ctes(psr_pm_cte(ctx), psr_pm2_cte(ctx), final=final)


def psr_t10(ctx: RunContext) -> str:
    fam = f"""SELECT h_id, report_name, species, family_name,
      CAST(round(rev_exact, 0) AS BIGINT) AS rev, CAST(round(total_exact, 0) AS BIGINT) AS total_rev,
      CASE WHEN total_exact = 0 THEN 0 ELSE {sr('rev_exact', 'total_exact', 2, 6)} END AS pct
    FROM (SELECT h_id, report_name, species, family_name, sum(rev) AS rev_exact,
                 sum(sum(rev)) OVER (PARTITION BY h_id, report_name, species) AS total_exact
          FROM pm2_m GROUP BY h_id, report_name, species, family_name)"""
    fam = f"SELECT * FROM ({fam}) WHERE pct > 0"
    t = _topn(fam, "rev", "total_rev")
    final = f"""SELECT t.h_id, c.location_number, t.report_name, t.species, t.fam AS product_name, t.row_order,
  {_reconciled()} / 100.0 AS rev_pct, {d(ctx.end_date)} AS end_date
FROM ({t}) t LEFT JOIN clinics c ON c.h_id = t.h_id"""
    return with_ctes(psr_pm_cte(ctx), psr_pm2_cte(ctx), final=final)


def psr_mm_cte(ctx: RunContext) -> str:
    lo, hi = ctx.months_window(-11, 0)
    ftype = ("CASE WHEN pr.type IS NOT NULL AND l.cost <> 0 AND l.quantity_norm IS NOT NULL "
             "AND l.quantity_norm <> 0 THEN pr.type END")
    mon = "CAST(date_trunc('month', l.invoice_date) AS DATE)"
    return f"""mm_base AS (
  SELECT DISTINCT l.patient_id, p.h_id, p.vi_species_id, {mon} AS data_month,
    sum(CASE WHEN {ftype} IN ('f','ft','fh') THEN l.quantity_norm ELSE 0 END) OVER (PARTITION BY l.patient_id, {mon}) AS ft_doses,
    sum(CASE WHEN {ftype} IN ('f','ft','fh') THEN l.quantity_norm ELSE 0 END) OVER (PARTITION BY l.patient_id) AS ft_doses_year,
    sum(CASE WHEN {ftype} IN ('h','fh') THEN l.quantity_norm ELSE 0 END) OVER (PARTITION BY l.patient_id, {mon}) AS hw_doses,
    sum(CASE WHEN {ftype} IN ('h','fh') THEN l.quantity_norm ELSE 0 END) OVER (PARTITION BY l.patient_id) AS hw_doses_year
  FROM lines l
  JOIN patients p ON p.patient_id = l.patient_id
  JOIN pm ON pm.patient_id = p.patient_id AND pm.h_id = p.h_id AND pm.wellness_care IS NOT NULL
  LEFT JOIN products pr ON pr.service_id = l.service_id
  WHERE l.invoice_date >= {d(lo)} AND l.invoice_date < {d(hi)} AND NOT l.voided AND p.vi_species_id IN (3, 7)),
mm AS (
  SELECT h_id, vi_species_id, data_month,
    count(DISTINCT CASE WHEN ft_doses > 0 THEN patient_id END) AS ft_patients,
    count(DISTINCT CASE WHEN hw_doses > 0 THEN patient_id END) AS hw_patients,
    count(DISTINCT patient_id) AS total_patients,
    CAST(sum(CASE WHEN ft_doses_year <= 0 THEN NULL ELSE ft_doses END) AS BIGINT) AS ft_doses,
    CAST(sum(CASE WHEN hw_doses_year <= 0 THEN NULL ELSE hw_doses END) AS BIGINT) AS hw_doses
  FROM mm_base GROUP BY 1, 2, 3)"""


def psr_month_master(ctx: RunContext) -> str:
    return with_ctes(psr_pm_cte(ctx), psr_mm_cte(ctx), final="SELECT * FROM mm")


def psr_t11(ctx: RunContext) -> str:
    months = ", ".join(f"({k}, {d(ctx.month(-(k - 1)))})" for k in range(1, 13))
    final = f"""SELECT g.h_id, g.location_number, g.report_name, g.species, {d(ctx.end_date)} AS end_date,
  strftime(mo.data_month, '%b') AS month, 13 - mo.row_order AS column_order,
  CAST(coalesce(mm.total_patients, 0) AS BIGINT) AS total_patients,
  CAST(coalesce(mm.total_patients - CASE WHEN g.report_name = 'Flea/Tick' THEN mm.ft_patients ELSE mm.hw_patients END, 0) AS BIGINT) AS pats_no_prod,
  CAST(coalesce(CASE WHEN g.report_name = 'Flea/Tick' THEN mm.ft_patients ELSE mm.hw_patients END, 0) AS BIGINT) AS pats_prod,
  CAST(coalesce(CASE WHEN g.report_name = 'Flea/Tick' THEN mm.ft_doses ELSE mm.hw_doses END, 0) AS BIGINT) AS total_doses
FROM grid g CROSS JOIN (VALUES {months}) mo(row_order, data_month)
LEFT JOIN mm ON mm.h_id = g.h_id AND (CASE WHEN mm.vi_species_id = 3 THEN 'Dog' ELSE 'Cat' END) = g.species
  AND mm.data_month = mo.data_month"""
    return with_ctes(psr_pm_cte(ctx), psr_mm_cte(ctx), GRID_CTE, final=final)


def psr_t12(ctx: RunContext) -> str:
    agg = f"""SELECT {CELLS}, {_bucket('m.doses', 13)} AS doses,
    count(DISTINCT m.patient_id) AS patients, sum(m.opp) AS missed
  FROM grid g LEFT JOIN pm_m m ON m.h_id = g.h_id AND m.report_name = g.report_name AND m.species = g.species AND {W}
  GROUP BY {CELLS}, 5"""
    diff = "CASE WHEN d.doses = '13+' THEN 0 ELSE d.dose_rec - CAST(d.doses AS BIGINT) END"
    final = f"""SELECT d.h_id, d.location_number, d.report_name, d.species, {d(ctx.end_date)} AS end_date,
  CAST(d.dose_rec AS BIGINT) AS dose_rec, d.doses, CAST(coalesce(a.patients, 0) AS BIGINT) AS patients,
  CAST(CASE WHEN ({diff}) < 0 THEN 0 ELSE ({diff}) END AS BIGINT) AS missed_doses,
  CAST(coalesce(a.missed, 0) AS BIGINT) AS total_missed_doses
FROM (SELECT g.*, lb.doses FROM grid g, {_labels(13)}) d
LEFT JOIN ({agg}) a ON a.h_id = d.h_id AND a.report_name = d.report_name AND a.species = d.species AND a.doses = d.doses"""
    return with_ctes(psr_pm_cte(ctx), GRID_CTE, final=final)


def psr_t13a(ctx: RunContext) -> str:
    bucket = ("CASE WHEN m.doses >= 12 THEN '12+' WHEN m.doses IS NULL OR m.doses <= 0 THEN '0' "
              "WHEN m.doses = 1 THEN '1' ELSE '2-11' END")
    agg = f"""SELECT {CELLS}, {bucket} AS doses, count(m.patient_id) AS patients
  FROM grid g LEFT JOIN pm_m m ON m.h_id = g.h_id AND m.report_name = g.report_name AND m.species = g.species AND {W}
  GROUP BY {CELLS}, 5"""
    part = "PARTITION BY d.h_id, d.report_name, d.species"
    base = f"""SELECT d.h_id, d.location_number, d.report_name, d.species, d.dose_rec, d.doses,
    coalesce(a.patients, 0) AS patients,
    CASE WHEN sum(coalesce(a.patients, 0)) OVER ({part}) = 0 THEN NULL
         ELSE {sr('coalesce(a.patients, 0)', f'sum(coalesce(a.patients, 0)) OVER ({part})', 2)} END AS u,
    dense_rank() OVER ({part} ORDER BY coalesce(a.patients, 0) DESC) AS row_order
  FROM (SELECT g.*, lb.doses FROM grid g, (VALUES ('0'), ('1'), ('2-11'), ('12+')) lb(doses)) d
  LEFT JOIN ({agg}) a ON a.h_id = d.h_id AND a.report_name = d.report_name AND a.species = d.species AND a.doses = d.doses"""
    s = "sum(u) OVER (PARTITION BY h_id, report_name, species)"
    final = f"""SELECT h_id, location_number, report_name, species, {d(ctx.end_date)} AS end_date,
  CAST(dose_rec AS BIGINT) AS dose_rec, doses, CAST(patients AS BIGINT) AS patients,
  (CASE WHEN {s} > 100 AND row_order = 1 THEN u - ({s} - 100)
        WHEN {s} < 100 AND row_order = 1 THEN u + (100 - {s}) ELSE u END) / 100.0 AS pct_pats
FROM ({base})"""
    return with_ctes(psr_pm_cte(ctx), GRID_CTE, final=final)


def psr_t13(ctx: RunContext) -> str:
    r = "g.dose_rec"
    lbl = f"""CASE pos.p
      WHEN 1 THEN '0 Doses'
      WHEN 2 THEN CASE WHEN {r} = 0 THEN '0+ Doses' WHEN {r} = 1 THEN '1+ Doses' ELSE '1 Dose' END
      WHEN 3 THEN CASE WHEN {r} <= 1 THEN NULL WHEN {r} = 2 THEN '2+ Doses' WHEN {r} = 3 THEN '2 Doses'
                       ELSE '2-' || CAST({r} - 1 AS VARCHAR) || ' Doses' END
      ELSE CASE WHEN {r} <= 2 THEN NULL WHEN {r} = 3 THEN '3+ Doses' ELSE CAST({r} AS VARCHAR) || '+ Doses' END END"""
    grid_l = f"SELECT * FROM (SELECT g.*, pos.p AS row_order, {lbl} AS doses FROM grid g, (VALUES (1), (2), (3), (4)) pos(p)) WHERE doses IS NOT NULL"
    dd = "coalesce(m.doses, 0)"
    rr = "m.rec"
    label = f"""CASE WHEN {dd} = 0 THEN '0 Doses'
      WHEN {rr} = 0 AND {dd} >= 1 THEN '0+ Doses'
      WHEN {rr} = 1 AND {dd} >= 1 THEN '1+ Doses'
      WHEN {rr} > 1 AND {dd} = 1 THEN '1 Dose'
      WHEN {rr} = 3 AND {dd} = 2 THEN '2 Doses'
      WHEN {rr} > 3 AND {dd} BETWEEN 2 AND {rr} - 1 THEN '2-' || CAST({rr} - 1 AS VARCHAR) || ' Doses'
      ELSE CAST({rr} AS VARCHAR) || '+ Doses' END"""
    agg = f"""SELECT m.h_id, m.report_name, m.species, {label} AS doses, count(DISTINCT m.patient_id) AS patients
  FROM pm_m m WHERE {W} GROUP BY 1, 2, 3, 4"""
    part = "PARTITION BY h_id, report_name, species"
    base = f"""SELECT d.h_id, d.location_number, d.report_name, d.species, d.dose_rec, d.doses, d.row_order,
    coalesce(a.patients, 0) AS patients,
    CASE WHEN sum(coalesce(a.patients, 0)) OVER (PARTITION BY d.h_id, d.report_name, d.species) = 0 THEN 0
         ELSE {sr('coalesce(a.patients, 0)', 'sum(coalesce(a.patients, 0)) OVER (PARTITION BY d.h_id, d.report_name, d.species)', 2)} END AS u
  FROM ({grid_l}) d LEFT JOIN ({agg}) a
    ON a.h_id = d.h_id AND a.report_name = d.report_name AND a.species = d.species AND a.doses = d.doses"""
    s = f"sum(u) OVER ({part})"
    mx = f"max(u) OVER ({part})"
    final = f"""SELECT h_id, location_number, report_name, species, {d(ctx.end_date)} AS end_date,
  CAST(dose_rec AS BIGINT) AS dose_rec, doses, CAST(patients AS BIGINT) AS patients,
  (CASE WHEN {s} <> 100 AND u = {mx} THEN u + (100 - {s}) ELSE u END) / 100.0 AS pct_pats,
  CAST(row_order AS BIGINT) AS row_order
FROM ({base})"""
    return with_ctes(psr_pm_cte(ctx), GRID_CTE, final=final)


# ------------------------------------------------------------- CONSUMER
from datetime import timedelta  # noqa: E402

from ..context import add_months  # noqa: E402

LINE_ORDER = "invoice_date, l_orderkey, l_linenumber, l_partkey, l_suppkey"
RE_NAME_JUNK = "(?i)\\*|[0-9]|do not|delete|decease|service|wrong|moved|dead"
RE_ADDR_JUNK = "(?i)do not|delete|decease|service|wrong|moved|dead"
RE_NAME_CHARS = "[[:cntrl:]]|\\^|\\*|\\)|\\(|:|\\+"
RE_CNTRL = "[[:cntrl:]]+"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(x: str, pat: str) -> str:
    return f"nullif(regexp_replace({x}, {_q(pat)}, '', 'g'), '')"


def months_between(a: str, b_: str) -> str:
    return (f"((year({a}) - year({b_})) * 12 + (month({a}) - month({b_})) + "
            f"CASE WHEN day({a}) = day({b_}) OR ({a} = last_day({a}) AND {b_} = last_day({b_})) THEN 0 "
            f"ELSE (day({a}) - day({b_})) / 31.0 END)")


def consumer_ctes(ctx: RunContext) -> list[str]:
    end = ctx.end_date
    mb = months_between(d(end), "p.dob")
    return [
        f"""cons_pat AS (
  SELECT p.patient_id, p.client_id, p.h_id, p.vi_species_id, p.dob, a.first_active, a.last_active,
    CASE WHEN {mb} > 72 AND p.vi_species_id = 3 THEN 1 ELSE 0 END AS dogs_over_6,
    CASE WHEN {mb} < 12 AND p.vi_species_id = 3 THEN 1 ELSE 0 END AS puppy,
    CASE WHEN {mb} > 48 AND p.vi_species_id = 3 THEN 1 ELSE 0 END AS dogs_over_4
  FROM patients p JOIN activity a ON a.patient_id = p.patient_id
  WHERE a.last_active > {d(add_months(end, -23))} AND p.is_active AND NOT p.is_deceased
    AND p.vi_species_id IN (3, 7) AND p.patient_id > 0)""",
        f"""cons_lines AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.patient_id, l.invoice_date, l.service_id,
    l.quantity_norm, l.cost, cp.client_id, cp.vi_species_id,
    pr.product, pr.family_name, pr.type, pr.service_kind, pr.product_info,
    (pr.type IS NOT NULL AND l.quantity_norm <> 0 AND l.invoice_date >= {d(add_months(end, -23))}) AS is_fth,
    l.invoice_date < {d(end - timedelta(days=1))} AS is_trans
  FROM lines l JOIN cons_pat cp ON cp.patient_id = l.patient_id
  LEFT JOIN products pr ON pr.service_id = l.service_id
  WHERE l.invoice_date >= {d(add_months(end, -24))} AND l.invoice_date < {d(end)} AND NOT l.voided)""",
    ]


PRODUCT_TAG_SQL = {
    "hg": "product LIKE 'Heartgard%'",
    "fl": "product LIKE 'Frontline%' AND family_name <> 'Tritak'",
    "ce": "product LIKE 'Certifect%'",
    "combo": "type IN ('fh', 'fth')",
    "comp_hg": "type = 'h' AND product NOT LIKE 'Heartgard%'",
    "comp_fl": "type IN ('ft', 'f') AND product NOT LIKE 'Frontline%' AND product NOT LIKE 'Certifect%'",
    "flt": "family_name = 'Tritak'",
    "ng": "family_name = 'NexGard'",
}


def _between(col: str, bounds) -> str:
    return f"{col} BETWEEN {d(bounds[0])} AND {d(bounds[1])}"


def product_metrics_sql(ctx: RunContext) -> str:
    w12, w24 = ctx.trailing(0), ctx.trailing(1)
    subs, cols = [], []
    for tag, pred in PRODUCT_TAG_SQL.items():
        subs.append(f"""LEFT JOIN (
    SELECT client_id, max(invoice_date) AS last_{tag}_purch,
      count(CASE WHEN {_between('invoice_date', w12)} THEN invoice_date END) AS {tag}_purch_12,
      count(CASE WHEN {_between('invoice_date', w24)} THEN invoice_date END) AS {tag}_purch_24,
      sum(CASE WHEN {_between('invoice_date', w12)} THEN CASE WHEN quantity_norm IS NULL THEN 0 ELSE cost END END) AS {tag}_rev_12,
      sum(CASE WHEN {_between('invoice_date', w24)} THEN CASE WHEN quantity_norm IS NULL THEN 0 ELSE cost END END) AS {tag}_rev_24,
      sum(CASE WHEN {_between('invoice_date', w12)} THEN coalesce(quantity_norm, 1) END) AS {tag}_doses_12,
      sum(CASE WHEN {_between('invoice_date', w24)} THEN coalesce(quantity_norm, 1) END) AS {tag}_doses_24,
      last(vi_species_id ORDER BY {LINE_ORDER}) AS {tag}_last_pet_species
    FROM cons_lines WHERE is_fth AND {pred} GROUP BY client_id) s_{tag} ON s_{tag}.client_id = c.client_id""")
        cols += [
            f"s_{tag}.last_{tag}_purch",
            f"coalesce(s_{tag}.{tag}_purch_12, 0) AS {tag}_purch_12",
            f"coalesce(s_{tag}.{tag}_purch_24, 0) AS {tag}_purch_24",
            f"CAST(s_{tag}.{tag}_rev_12 AS DOUBLE) AS {tag}_rev_12",
            f"CAST(s_{tag}.{tag}_rev_24 AS DOUBLE) AS {tag}_rev_24",
            f"CAST(s_{tag}.{tag}_doses_12 AS BIGINT) AS {tag}_doses_12",
            f"CAST(s_{tag}.{tag}_doses_24 AS BIGINT) AS {tag}_doses_24",
            f"s_{tag}.{tag}_last_pet_species",
        ]
    other = f"""LEFT JOIN (
    SELECT client_id,
      sum(CASE WHEN product LIKE 'Interceptor%' AND {_between('invoice_date', w12)} THEN quantity_norm ELSE 0 END) AS int_doses_12,
      sum(CASE WHEN product LIKE 'Interceptor%' AND {_between('invoice_date', w24)} THEN quantity_norm ELSE 0 END) AS int_doses_24,
      sum(CASE WHEN family_name = 'Trifexis' AND {_between('invoice_date', w12)} THEN quantity_norm ELSE 0 END) AS trif_doses,
      sum(CASE WHEN family_name = 'Revolution' AND {_between('invoice_date', w12)} THEN quantity_norm ELSE 0 END) AS rev_doses,
      sum(CASE WHEN family_name = 'Advantage Multi' AND {_between('invoice_date', w12)} THEN quantity_norm ELSE 0 END) AS adv_doses
    FROM cons_lines WHERE is_fth GROUP BY client_id) s_other ON s_other.client_id = c.client_id"""
    cols += [f"CAST(s_other.{c} AS BIGINT) AS {c}" for c in ("int_doses_12", "int_doses_24", "trif_doses", "rev_doses", "adv_doses")]
    return (f"SELECT c.client_id, {', '.join(cols)}\nFROM (SELECT DISTINCT client_id FROM cons_lines WHERE is_fth) c\n"
            + "\n".join(subs) + "\n" + other)


def consumer_product_metrics(ctx: RunContext) -> str:
    return with_ctes(*consumer_ctes(ctx), final=product_metrics_sql(ctx))


SERVICE_TAG_SQL = {
    "pain": "service_kind = 'nsaid'",
    "dental": "service_kind = 'general' AND product_info = 'Surgery - dental'",
    "surg": "service_kind = 'general' AND product_info LIKE 'Surgery%' AND product_info <> 'Surgery - dental'",
    "vacc": "service_kind = 'vaccine'",
    "board": "service_kind = 'general' AND lower(product_info) = 'service - boarding'",
    "groom": "service_kind = 'general' AND lower(product_info) = 'service - grooming'",
    "other": ("NOT coalesce(service_kind = 'general' AND (product_info LIKE 'Surgery%' OR lower(product_info) LIKE '%dental%' "
              "OR lower(product_info) IN ('service - boarding', 'service - grooming')), false) "
              "AND NOT is_fth AND NOT coalesce(service_kind IN ('nsaid', 'vaccine'), false)"),
}


def service_metrics_sql(ctx: RunContext) -> str:
    end = ctx.end_date
    w14 = (add_months(end, -14), end)
    subs, cols = [], []
    for tag, pred in SERVICE_TAG_SQL.items():
        subs.append(f"""LEFT JOIN (
    SELECT client_id,
      count(CASE WHEN {_between('invoice_date', w14)} THEN 1 END) AS num_{tag}_purch,
      max(invoice_date) AS last_{tag}_purch,
      sum(CASE WHEN {_between('invoice_date', w14)} THEN cost ELSE 0 END) AS dollar_{tag}_purch
    FROM cons_lines WHERE is_trans AND cost <> 0 AND {pred} GROUP BY client_id) s_{tag} ON s_{tag}.client_id = c.client_id""")
        cols += [
            f"coalesce(s_{tag}.num_{tag}_purch, 0) AS num_{tag}_purch",
            f"s_{tag}.last_{tag}_purch",
            f"CAST(coalesce(s_{tag}.dollar_{tag}_purch, 0) AS DOUBLE) AS dollar_{tag}_purch",
        ]
    visits = f"""LEFT JOIN (
    SELECT client_id,
      count(DISTINCT CASE WHEN invoice_date BETWEEN {d(add_months(end, -12))} AND {d(end - timedelta(days=1))} THEN invoice_date END) AS num_visits,
      max(invoice_date) AS last_visit
    FROM cons_lines WHERE is_trans GROUP BY client_id) v ON v.client_id = c.client_id"""
    cols += ["v.num_visits", "v.last_visit"]
    return (f"SELECT c.client_id, {', '.join(cols)}\nFROM (SELECT DISTINCT client_id FROM cons_lines WHERE is_trans) c\n"
            + "\n".join(subs) + "\n" + visits)


def consumer_service_metrics(ctx: RunContext) -> str:
    return with_ctes(*consumer_ctes(ctx), final=service_metrics_sql(ctx))


def consumer_patient_counts(ctx: RunContext) -> str:
    lo, hi = ctx.trailing(0)
    return with_ctes(*consumer_ctes(ctx), final=f"""SELECT c.h_id,
  count(DISTINCT CASE WHEN c.vi_species_id = 3 AND p.type IN ('ft', 'f') THEN c.patient_id END) AS ft_canine_patients,
  count(DISTINCT CASE WHEN c.vi_species_id = 7 AND p.type IN ('ft', 'f') THEN c.patient_id END) AS ft_feline_patients,
  count(DISTINCT CASE WHEN c.vi_species_id = 3 AND p.type = 'h' THEN c.patient_id END) AS hw_canine_patients
FROM (SELECT * FROM cons_lines WHERE is_fth AND invoice_date BETWEEN {d(lo)} AND {d(hi)}) p
RIGHT JOIN cons_pat c ON c.patient_id = p.patient_id
GROUP BY c.h_id""")


def consumer_competitor_products(ctx: RunContext) -> str:
    return with_ctes(*consumer_ctes(ctx), final=competitor_sql(ctx))


def competitor_sql(ctx: RunContext) -> str:
    lo, hi = ctx.trailing(0)
    base = f"SELECT * FROM cons_lines WHERE is_fth AND invoice_date BETWEEN {d(lo)} AND {d(hi)}"
    def one(market: str, pred: str) -> str:
        return f"""SELECT '{market}' AS market, client_id, family_name AS product, product AS product_detail,
    CAST(doses AS BIGINT) AS doses, last_date,
    CAST(rank() OVER (PARTITION BY client_id ORDER BY doses, last_date, last_id) AS BIGINT) AS product_order
  FROM (SELECT client_id, product, any_value(family_name) AS family_name,
          sum(CASE WHEN quantity_norm IS NULL OR quantity_norm = 0 THEN 1 ELSE quantity_norm END) AS doses,
          max(invoice_date) AS last_date,
          max((l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS last_id
        FROM ({base}) WHERE {pred} GROUP BY client_id, product)"""
    return (one("FL", "product NOT LIKE 'Frontline%' AND product NOT LIKE 'Certifect%' AND type IN ('ft', 'f')")
            + "\nUNION ALL\n" + one("HG", "product NOT LIKE 'Heartgard%' AND type = 'h'"))


def clients_clean_cte(ctx: RunContext) -> str:
    name = lambda c: f"coalesce({_strip(_strip(c, RE_NAME_JUNK), RE_NAME_CHARS)}, 'None Given')"
    addr = lambda c: _strip(_strip(c, RE_ADDR_JUNK), RE_CNTRL)
    return f"""cons_clients AS (
  SELECT * FROM (
    SELECT c.client_id, c.h_id,
      {name('c.first_name')} AS first_name,
      {name('c.last_name')} AS last_name,
      CASE WHEN nullif(c.title, '') IS NULL THEN NULL WHEN regexp_matches(c.title, {_q('[^A-Za-z |.]|' + chr(92) + chr(92))}) THEN NULL ELSE c.title END AS prefix,
      coalesce({addr('c.address1')}, 'None Given') AS address1,
      {addr('c.address2')} AS address2,
      {_strip('c.city', RE_CNTRL)} AS city,
      {_strip('c.state', RE_CNTRL)} AS state,
      {_strip(f"lpad(substr(CASE WHEN regexp_matches(c.postal_code, '[^0-9]') THEN nullif(regexp_replace(c.postal_code, '[^0-9]', '', 'g'), '') ELSE c.postal_code END, 1, 9), 30, ' ')", RE_CNTRL)} AS postal_code,
      {_strip(f"substr(CASE WHEN regexp_matches(c.phone1, '[^0-9]') THEN nullif(regexp_replace(c.phone1, '[^0-9]', '', 'g'), '') ELSE c.phone1 END, 1, 10)", RE_CNTRL)} AS phone1,
      c.primary_email,
      h.dogs_over_6, CAST(h.dogs_over_4 AS BIGINT) AS dogs_over_4, h.puppy, h.canines, h.felines, h.first_visit
    FROM clients c JOIN (
      SELECT client_id, max(dogs_over_6) AS dogs_over_6, sum(dogs_over_4) AS dogs_over_4, max(puppy) AS puppy,
        count(DISTINCT CASE WHEN vi_species_id = 3 THEN patient_id END) AS canines,
        count(DISTINCT CASE WHEN vi_species_id = 7 THEN patient_id END) AS felines,
        min(first_active) AS first_visit
      FROM cons_pat GROUP BY client_id) h ON h.client_id = c.client_id)
  WHERE NOT coalesce({deny_sql('first_name', 'last_name', 'address1', 'address2')}, false)
    AND NOT coalesce(regexp_matches(upper(state), '^(AB|BC|MB|NB|NL|NT|NS|NU|ON|PE|QC|SK|YT|PR)'), false))"""


def deny_sql(first: str, last: str, a1: str, a2: str) -> str:
    from ..operators import contact as cl

    def isin(c, vals):
        return f"upper({c}) IN ({', '.join(_q(v) for v in vals)})"

    def infix(c, parts):
        return "(" + " OR ".join(f"contains(upper({c}), {_q(p)})" for p in parts) + ")"

    return ("(" + " OR ".join([
        isin(first, cl.FIRST_NAME_EXACT), infix(first, cl.NAME_INFIX),
        isin(last, cl.LAST_NAME_EXACT), infix(last, cl.NAME_INFIX),
        isin(a1, cl.ADDRESS1_EXACT), f"contains(upper({a1}), '*')",
        isin(a2, cl.ADDRESS2_EXACT), infix(a2, cl.ADDRESS2_INFIX),
        f"(upper({first}) = 'CASH' AND upper({last}) IN ('CLIENT', 'CASH'))",
    ]) + ")")


def consumer_clients(ctx: RunContext) -> str:
    return with_ctes(*consumer_ctes(ctx), clients_clean_cte(ctx), final="SELECT * FROM cons_clients")


def _mdy(c: str) -> str:
    return f"strftime({c}, '%m/%d/%Y')"


def _money(c: str) -> str:
    return f"CAST(round(CAST(coalesce({c}, 0) AS DECIMAL(38,4)), 2) AS VARCHAR)"


def consumer_report(ctx: RunContext) -> str:
    cols = ["'1DT' AS record_type", "c.client_id", "c.h_id", "c.prefix", "c.first_name", "c.last_name",
            "c.address1", "c.address2", "c.city", "c.state", "c.postal_code", "c.phone1",
            f"CASE WHEN regexp_matches(c.primary_email, {_q('(?i)^[A-Z0-9._%+-]+@[A-Z0-9.-]+[.][A-Z]{2,4}$')}) THEN c.primary_email END AS email",
            "c.canines", "c.felines", "c.dogs_over_6", "c.dogs_over_4", "c.puppy", f"{_mdy('c.first_visit')} AS first_visit"]
    for tag in PRODUCT_TAG_SQL:
        cols += [
            f"{_mdy(f'pm.last_{tag}_purch')} AS last_{tag}_purch",
            f"coalesce(pm.{tag}_purch_12, 0) AS {tag}_purch_12",
            f"coalesce(pm.{tag}_purch_24, 0) AS {tag}_purch_24",
            f"{_money(f'pm.{tag}_rev_12')} AS {tag}_rev_12",
            f"{_money(f'pm.{tag}_rev_24')} AS {tag}_rev_24",
            f"CAST(greatest(coalesce(pm.{tag}_doses_12, 0), 0) AS BIGINT) AS {tag}_doses_12",
            f"CAST(greatest(coalesce(pm.{tag}_doses_24, 0), 0) AS BIGINT) AS {tag}_doses_24",
        ]
        cols.append(f"pm.{tag}_last_pet_species")
    for tag in SERVICE_TAG_SQL:
        cols += [
            f"coalesce(sm.num_{tag}_purch, 0) AS num_{tag}_purch",
            f"{_mdy(f'sm.last_{tag}_purch')} AS last_{tag}_purch",
            f"{_money(f'sm.dollar_{tag}_purch')} AS dollar_{tag}_purch",
        ]
    cols += ["coalesce(sm.num_visits, 0) AS num_visits", f"{_mdy('sm.last_visit')} AS last_visit"]
    cols += [f"CAST(coalesce(pm.{x}, 0) AS BIGINT) AS {x}"
             for x in ("int_doses_12", "int_doses_24", "trif_doses", "rev_doses", "adv_doses")]
    cols += ["cp.comp_fl_product", "cp.comp_hg_product", f"{_mdy('pv.last_prev_purch')} AS last_prev_purch"]
    cols += [f"CAST(coalesce(pv.{x}, 0) AS BIGINT) AS {x}"
             for x in ("prev_purch_12", "prev_purch_24", "prev_doses_12", "prev_doses_24", "prev_pats_12")]
    cols += [f"{_money(f'pv.{x}')} AS {x}" for x in ("prev_rev_12", "prev_rev_24")]
    cols += [f"CAST(coalesce(pv.{x}, 0) AS DOUBLE) AS {x}" for x in ("prev_pills_12", "prev_pills_24")]
    cols.append("pv.prev_last_pet_species")
    final = f"""SELECT {', '.join(cols)}
FROM cons_clients c
LEFT JOIN ({product_metrics_sql(ctx)}) pm ON pm.client_id = c.client_id
LEFT JOIN ({service_metrics_sql(ctx)}) sm ON sm.client_id = c.client_id
LEFT JOIN (SELECT client_id, max(CASE WHEN market = 'FL' THEN product END) AS comp_fl_product,
                  max(CASE WHEN market = 'HG' THEN product END) AS comp_hg_product
           FROM ({competitor_sql(ctx)}) WHERE product_order = 1 GROUP BY client_id) cp ON cp.client_id = c.client_id
LEFT JOIN ({nsaid_metrics_sql(ctx)}) pv ON pv.client_id = c.client_id"""
    return with_ctes(*consumer_ctes(ctx), clients_clean_cte(ctx), consumer_nsaid_cte(ctx), final=final)


# ---------------------------------------------------------------- NSAID
def _pills_below_sql(q: str, dv: str, n: int) -> str:
    return f"(CASE WHEN {dv} > 0 THEN {q} < {dv} * {n} ELSE {q} > {dv} * {n} END)"


def consumer_nsaid_cte(ctx: RunContext) -> str:
    end = ctx.end_date
    fams = ", ".join(str(x) for x in b.EXCUSED_SURGERY_FAMILIES)
    return f"""cons_nsaid AS (
  SELECT s.lineitem_id, s.patient_id, cp.client_id, cp.h_id, cp.vi_species_id, s.invoice_date, s.product,
    CAST(s.quantity AS BIGINT) AS quantity, CAST(s.dosage_volume AS BIGINT) AS dosage_volume,
    CAST(s.cost AS DOUBLE) AS cost,
    {ratio_round('s.quantity', 's.dosage_volume', 4)} AS pills,
    CASE WHEN EXISTS (SELECT 1 FROM appointments a WHERE a.patient_id = s.patient_id AND a.appointment_date = s.invoice_date)
         THEN 'Y' ELSE 'N' END AS appointment_flag
  FROM nsaid_sales s JOIN cons_pat cp ON cp.patient_id = s.patient_id
  WHERE s.product = 'Previcox' AND NOT s.voided
    AND s.invoice_date BETWEEN {d(add_months(end, -12))} AND {d(end)}
    AND s.dosage_volume IS NOT NULL AND s.dosage_volume <> 0 AND s.quantity <> 0
    AND NOT ({_pills_below_sql('s.quantity', 's.dosage_volume', 10)} AND EXISTS (
      SELECT 1 FROM surgeries g WHERE g.patient_id = s.patient_id AND g.surgery_family IN ({fams}) AND g.cost > 0
        AND s.invoice_date BETWEEN g.surgery_date - 5 AND g.surgery_date + 5)))"""


def consumer_nsaid(ctx: RunContext) -> str:
    return with_ctes(*consumer_ctes(ctx), consumer_nsaid_cte(ctx), final="SELECT * FROM cons_nsaid")


def consumer_nsaid_metrics(ctx: RunContext) -> str:
    return with_ctes(*consumer_ctes(ctx), consumer_nsaid_cte(ctx), final=nsaid_metrics_sql(ctx))


def nsaid_metrics_sql(ctx: RunContext) -> str:
    w12, w24 = ctx.trailing(0), ctx.trailing(1)
    p9 = sr("quantity", "dosage_volume", 9)
    final = f"""SELECT client_id, max(invoice_date) AS last_prev_purch,
  count(CASE WHEN {_between('invoice_date', w12)} THEN invoice_date END) AS prev_purch_12,
  CAST(sum(CASE WHEN {_between('invoice_date', w12)} THEN cost END) AS DOUBLE) AS prev_rev_12,
  CAST(sum(CASE WHEN {_between('invoice_date', w12)} THEN coalesce(quantity, 1) END) AS BIGINT) AS prev_doses_12,
  count(CASE WHEN {_between('invoice_date', w24)} THEN invoice_date END) AS prev_purch_24,
  CAST(sum(CASE WHEN {_between('invoice_date', w24)} THEN cost END) AS DOUBLE) AS prev_rev_24,
  CAST(sum(CASE WHEN {_between('invoice_date', w24)} THEN coalesce(quantity, 1) END) AS BIGINT) AS prev_doses_24,
  last(vi_species_id ORDER BY invoice_date, lineitem_id) AS prev_last_pet_species,
  count(DISTINCT CASE WHEN {_between('invoice_date', w12)} THEN patient_id END) AS prev_pats_12,
  {sr(f"sum(CASE WHEN {_between('invoice_date', w12)} THEN coalesce({p9}, 1000000000) END)", '1000000000', 2)} / 100.0 AS prev_pills_12,
  {sr(f"sum(CASE WHEN {_between('invoice_date', w24)} THEN coalesce({p9}, 1000000000) END)", '1000000000', 2)} / 100.0 AS prev_pills_24
FROM cons_nsaid GROUP BY client_id"""
    return final


def weight_sql(w: str, u: str) -> str:
    num = f"TRY_CAST({w} AS DECIMAL(18,4))"
    return (f"CASE WHEN {u} = 'lbs' THEN {num} WHEN upper({u}) = 'POUNDS' THEN {num} "
            f"WHEN upper({u}) = 'OUNCES' THEN {num} * 0.0625 WHEN upper({u}) = 'KILOGRAMS' THEN {num} * 2.2 "
            f"WHEN upper({u}) = 'GRAMS' THEN {num} * 0.0022 ELSE {num} END")


def pw_cte(ctx: RunContext, dogs_only=True, max_weight=None, months_active=23, code_filter=False, name="pw",
           age_digits: int = 3) -> str:
    end = ctx.end_date
    e = d(end)
    units = (f"(((year({e}) - year(p.dob)) * 12 + (month({e}) - month(p.dob))) * 31 + "
             f"CASE WHEN day({e}) = day(p.dob) OR ({e} = last_day({e}) AND p.dob = last_day(p.dob)) THEN 0 "
             f"ELSE day({e}) - day(p.dob) END)")
    age = ratio_round(units, "372", age_digits, when_zero="NULL")
    mb = months_between(d(end), "p.dob")
    species = "(3)" if dogs_only else "(3, 7)"
    wfilter = f"WHERE weight < {max_weight}" if max_weight is not None else ""
    code = "AND coalesce(p.pms_code, 2) IN (2, 3, 4)" if code_filter else ""
    return f"""{name}_w AS (
  SELECT patient_id, weight FROM (
    SELECT patient_id, {weight_sql('weight', 'weight_unit')} AS weight,
      row_number() OVER (PARTITION BY patient_id ORDER BY visit_date DESC, vital_id DESC) AS rn
    FROM vitals) WHERE rn = 1),
{name} AS (
  SELECT p.patient_id, p.client_id, p.h_id, p.vi_species_id, a.first_active, a.last_active, p.pms_code,
    CAST(w.weight AS DOUBLE) AS weight, {age} AS age_years,
    CASE WHEN {mb} > 60 AND p.vi_species_id = 3 THEN 1 ELSE 0 END AS dogs_over_5,
    CASE WHEN {mb} > 72 AND p.vi_species_id = 3 THEN 1 ELSE 0 END AS dogs_over_6,
    CASE WHEN {mb} < 12 AND p.vi_species_id = 3 THEN 1 ELSE 0 END AS puppy,
    CASE WHEN {mb} > 48 AND p.vi_species_id = 3 THEN 1 ELSE 0 END AS dogs_over_4
  FROM patients p JOIN activity a ON a.patient_id = p.patient_id
  LEFT JOIN (SELECT * FROM {name}_w {wfilter}) w ON w.patient_id = p.patient_id
  WHERE a.last_active > {d(add_months(end, -months_active))} AND p.is_active AND NOT p.is_deceased
    AND p.vi_species_id IN {species} AND p.patient_id > 0 {code})"""


def nsaid_patients(ctx: RunContext) -> str:
    return with_ctes(pw_cte(ctx), final="SELECT * FROM pw")


def last_dose_patients(ctx: RunContext) -> str:
    return with_ctes(pw_cte(ctx, dogs_only=False, max_weight=500, months_active=24, code_filter=True, age_digits=6),
                     final="SELECT * FROM pw")


def nsaid_clients_cte(ctx: RunContext) -> str:
    name = lambda c: f"coalesce({_strip(_strip(c, RE_NAME_JUNK), RE_CNTRL)}, 'None Given')"
    addr = lambda c: _strip(_strip(c, RE_ADDR_JUNK), RE_CNTRL)
    return f"""ns_cli AS (
  SELECT * FROM (
    SELECT c.client_id, c.h_id, {name('c.first_name')} AS first_name, {name('c.last_name')} AS last_name,
      {_strip('c.title', RE_CNTRL)} AS prefix,
      coalesce({addr('c.address1')}, 'None Given') AS address1, {addr('c.address2')} AS address2,
      {_strip('c.city', RE_CNTRL)} AS city, {_strip('c.state', RE_CNTRL)} AS state,
      {_strip("lpad(substr(CASE WHEN regexp_matches(c.postal_code, '[^0-9]') THEN nullif(regexp_replace(c.postal_code, '[^0-9]', '', 'g'), '') ELSE c.postal_code END, 1, 9), 30, ' ')", RE_CNTRL)} AS postal_code,
      {_strip("substr(CASE WHEN regexp_matches(c.phone1, '[^0-9]') THEN nullif(regexp_replace(c.phone1, '[^0-9]', '', 'g'), '') ELSE c.phone1 END, 1, 10)", RE_CNTRL)} AS phone1,
      c.primary_email, h.dogs_over_5, h.canines, h.first_visit
    FROM clients c JOIN (
      SELECT client_id, max(dogs_over_5) AS dogs_over_5,
        count(DISTINCT CASE WHEN vi_species_id = 3 THEN patient_id END) AS canines, min(first_active) AS first_visit
      FROM pw GROUP BY client_id) h ON h.client_id = c.client_id)
  WHERE NOT coalesce(first_name = 'None Given' OR last_name = 'None Given' OR address1 = ' ' OR address1 = 'None Given'
      OR address1 LIKE '%*%' OR address2 LIKE '%*%' OR state IS NULL OR city IS NULL
      OR regexp_matches(upper(state), '^(AB|BC|MB|NB|NL|NT|NS|NU|ON|PE|QC|SK|YT|PR)')
      OR postal_code IS NULL OR postal_code LIKE '%0000%' OR postal_code IN ('000000', '0', '00', '000')
      OR upper(first_name) IN ('OTC', 'OVER THE COUNTER', 'NEW', 'NEW CLIENT', 'TEST')
      OR upper(last_name) IN ('OTC', 'OVER THE COUNTER', 'CLIENT', 'NEW CLIENT', 'TEST CLIENT')
      OR upper(address1) IN ('OTC', 'OVER THE COUNTER') OR upper(address2) IN ('OTC', 'OVER THE COUNTER')
      OR (upper(first_name) = 'CASH' AND upper(last_name) IN ('CLIENT', 'CASH')), false))"""


def nsaid_clients(ctx: RunContext) -> str:
    return with_ctes(pw_cte(ctx), nsaid_clients_cte(ctx), final="SELECT * FROM ns_cli")


def nsaid_purchase_file(ctx: RunContext) -> str:
    end = ctx.end_date
    start = add_months(end, -11)
    prods = ", ".join(_q(x) for x in b.NSAID_PRODUCTS)
    detail = f"""SELECT '2DT' AS record_type,
    CAST(CASE WHEN s.lineitem_id < 1 THEN 4294967297 - s.lineitem_id ELSE s.lineitem_id END AS VARCHAR) AS lineitem_id,
    CAST(s.client_id AS VARCHAR) AS client_id,
    substr(c.first_name, 1, 30) AS first_name, substr(c.last_name, 1, 30) AS last_name,
    substr(c.address1, 1, 40) AS address1, substr(c.address2, 1, 40) AS address2,
    substr(c.city, 1, 30) AS city, substr(c.state, 1, 2) AS state, trim(c.postal_code) AS postal_code,
    CASE WHEN regexp_matches(c.primary_email, {_q('(?i)^[A-Z0-9._%+-]+@[A-Z0-9.-]+[.][A-Z]{2,4}$')}) THEN c.primary_email END AS primary_email,
    CAST(c.canines AS BIGINT) AS canines, {_mdy('s.invoice_date')} AS purchase_date,
    CASE WHEN s.product LIKE 'Rimadyl%' THEN 'Rimadyl' ELSE s.product END AS product,
    {ratio_round('s.quantity', 's.dosage_volume', 4)} AS pills,
    {_money('s.cost')} AS purchase_price,
    CAST(coalesce(round(s.weight, 0), 0) AS DOUBLE) AS weight, c.h_id
  FROM (SELECT n.*, pw.client_id AS pclient, pw.weight FROM nsaid_sales n JOIN pw ON pw.patient_id = n.patient_id
        WHERE n.invoice_date >= {d(start)} AND n.invoice_date < {d(add_months(end, 1))} AND NOT n.voided
          AND n.cost <> 0 AND n.product IN ({prods})) s
  JOIN ns_cli c ON c.client_id = s.pclient"""
    cols = ["record_type", "lineitem_id", "client_id", "first_name", "last_name", "address1", "address2", "city",
            "state", "postal_code", "primary_email", "canines", "purchase_date", "product", "pills",
            "purchase_price", "weight", "h_id"]
    head = {"record_type": "'1HD'", "lineitem_id": f"'{ctx.as_of.strftime('%m/%d/%Y')}'", "client_id": "account_number",
            "first_name": "CAST(location_number AS VARCHAR)", "last_name": "substr(clinic_name, 1, 40)", "h_id": "h_id"}
    types = {"canines": "BIGINT", "pills": "DOUBLE", "weight": "DOUBLE"}
    def row(vals):
        return ", ".join(f"{vals.get(c, f'CAST(NULL AS {types.get(c, chr(86) + chr(65) + chr(82) + chr(67) + chr(72) + chr(65) + chr(82))})')} AS {c}" for c in cols)
    trail = {"record_type": "'3TR'", "lineitem_id": "CAST(coalesce(n.n, 0) + 2 AS VARCHAR)", "h_id": "c.h_id"}
    final = f"""SELECT * FROM ({detail})
UNION ALL SELECT {row(head)} FROM clinics
UNION ALL SELECT {row(trail)} FROM clinics c LEFT JOIN (SELECT h_id, count(*) AS n FROM ({detail}) GROUP BY h_id) n ON n.h_id = c.h_id"""
    return with_ctes(pw_cte(ctx), nsaid_clients_cte(ctx), final=final)


# ------------------------------------------------------------------ PPR
def ppr_periods(ctx: RunContext):
    y = ctx.end_date.year
    return [(f"Total {y}", -2, 0), (f"Total {y - 1}", -14, -12)]


def _period_sql(month: str, ctx: RunContext) -> str:
    parts = " ".join(f"WHEN {month} BETWEEN {d(ctx.month(a))} AND {d(ctx.month(z))} THEN '{n}'" for n, a, z in ppr_periods(ctx))
    return f"CASE {parts} END"


def ppr_ctes(ctx: RunContext) -> list[str]:
    lo, hi = ctx.month(-14), ctx.month(1)
    ftype = ("CASE WHEN pr.type IS NOT NULL AND l.quantity_norm IS NOT NULL AND l.quantity_norm <> 0 "
             "AND l.cost <> 0 THEN pr.type END")
    mon = "CAST(date_trunc('month', l.invoice_date) AS DATE)"
    return [f"""ppm_raw AS (
  SELECT {_period_sql(mon, ctx)} AS time_period, p.h_id, l.patient_id, p.vi_species_id, {mon} AS month,
    sum(CASE WHEN {ftype} IN ('f','ft','fh') THEN l.quantity_norm ELSE 0 END) AS ft_doses,
    sum(CASE WHEN {ftype} IN ('h','fh') THEN l.quantity_norm ELSE 0 END) AS hw_doses,
    round(sum(CASE WHEN {ftype} = 'fh' THEN l.cost * CAST(0.66 AS DECIMAL(3,2)) WHEN {ftype} IN ('f','ft') THEN l.cost ELSE 0 END), 2) AS ft_rev,
    round(sum(CASE WHEN {ftype} = 'fh' THEN l.cost * CAST(0.33 AS DECIMAL(3,2)) WHEN {ftype} = 'h' THEN l.cost ELSE 0 END), 2) AS hw_rev,
    count(DISTINCT l.invoice_date) AS visits,
    count(DISTINCT CASE WHEN {ftype} IN ('f','ft','fh') THEN l.invoice_date END) AS ft_visits,
    count(DISTINCT CASE WHEN {ftype} IN ('h','fh') THEN l.invoice_date END) AS hw_visits,
    count(w.is_wellness) AS wellness
  FROM lines l JOIN patients p ON p.patient_id = l.patient_id
  LEFT JOIN products pr ON pr.service_id = l.service_id
  LEFT JOIN wellness w ON w.service_id = l.service_id
  WHERE l.invoice_date >= {d(lo)} AND l.invoice_date < {d(hi)} AND NOT coalesce(l.voided, false) AND p.vi_species_id IN (3, 7)
    AND {_period_sql(mon, ctx)} IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5),
ppm AS (
  SELECT * FROM (
    SELECT time_period, h_id, patient_id, vi_species_id, month,
      CASE WHEN ft_doses <= 0 THEN NULL ELSE ft_doses END AS ft_doses,
      CASE WHEN hw_doses <= 0 THEN NULL ELSE hw_doses END AS hw_doses,
      CASE WHEN ft_doses <= 0 THEN NULL ELSE ft_rev END AS ft_rev,
      CASE WHEN hw_doses <= 0 THEN NULL ELSE hw_rev END AS hw_rev,
      visits, ft_visits, hw_visits,
      sum(wellness) OVER (PARTITION BY time_period, h_id, patient_id) AS wellness_care
    FROM ppm_raw) WHERE wellness_care > 0),
ppm_m AS (
  SELECT time_period, h_id, patient_id, vi_species_id, month, visits, 'Flea/Tick' AS report_name,
         ft_doses AS doses, ft_rev AS rev, ft_visits AS mkt_visits FROM ppm
  UNION ALL
  SELECT time_period, h_id, patient_id, vi_species_id, month, visits, 'Heartworm', hw_doses, hw_rev, hw_visits FROM ppm)"""]


def ppr_patient_master(ctx: RunContext) -> str:
    return with_ctes(*ppr_ctes(ctx), final="""SELECT time_period, h_id, patient_id, vi_species_id, month,
  CAST(ft_doses AS BIGINT) AS ft_doses, CAST(hw_doses AS BIGINT) AS hw_doses,
  CAST(ft_rev AS DOUBLE) AS ft_rev, CAST(hw_rev AS DOUBLE) AS hw_rev,
  visits, ft_visits, hw_visits, CAST(wellness_care AS BIGINT) AS wellness_care FROM ppm""")


def ppr_pm2_cte(ctx: RunContext) -> str:
    lo, hi = ctx.month(-14), ctx.month(1)
    mon = "CAST(date_trunc('month', l.invoice_date) AS DATE)"
    return f"""ppm2 AS (
  SELECT {_period_sql(mon, ctx)} AS time_period, p.h_id, p.vi_species_id, pr.family_name,
    CASE WHEN pr.type = 'f' THEN 'ft' ELSE pr.type END AS type,
    count(DISTINCT p.patient_id) AS patients, CAST(sum(l.quantity_norm) AS BIGINT) AS doses
  FROM lines l JOIN patients p ON p.patient_id = l.patient_id
  JOIN products pr ON pr.service_id = l.service_id AND pr.type IS NOT NULL
  WHERE l.invoice_date >= {d(lo)} AND l.invoice_date < {d(hi)} AND NOT coalesce(l.voided, false) AND p.vi_species_id IN (3, 7)
    AND l.quantity_norm IS NOT NULL AND l.quantity_norm <> 0 AND l.cost <> 0
    AND EXISTS (SELECT 1 FROM ppm WHERE ppm.patient_id = l.patient_id AND ppm.h_id = p.h_id
                AND ppm.time_period = {_period_sql(mon, ctx)})
  GROUP BY 1, 2, 3, 4, 5)"""


def ppr_product_master(ctx: RunContext) -> str:
    return with_ctes(*ppr_ctes(ctx), ppr_pm2_cte(ctx), final="SELECT * FROM ppm2")


def _ppr_metrics(src: str, key: str) -> str:
    return f"""SELECT h_id, vi_species_id, report_name, {key} AS col_key,
    count(DISTINCT patient_id) AS unique_patients,
    count(DISTINCT patient_id) - count(DISTINCT CASE WHEN doses IS NOT NULL THEN patient_id END) AS unique_pat_no_prod,
    count(DISTINCT CASE WHEN doses IS NOT NULL THEN patient_id END) AS unique_pat_with_prod,
    sum(doses) AS prod_doses, sum(mkt_visits) AS trans,
    CASE WHEN sum(mkt_visits) = 0 THEN 0.0 ELSE {ratio_round('sum(doses)', 'sum(mkt_visits)', 2, when_null=None)} END AS prod_doses_per_trans,
    sum(rev) AS rev
  FROM {src} GROUP BY h_id, vi_species_id, report_name, {key}"""


def ppr_t1_pre(ctx: RunContext) -> str:
    body = _ppr_metrics("ppm_m", "time_period").replace("AS col_key", "AS time_period")
    return with_ctes(*ppr_ctes(ctx), final=f"""SELECT h_id, vi_species_id, report_name, time_period, unique_patients,
  unique_pat_no_prod, unique_pat_with_prod, CAST(prod_doses AS BIGINT) AS prod_doses, CAST(trans AS BIGINT) AS trans,
  prod_doses_per_trans, CAST(rev AS DOUBLE) AS rev
FROM ({body})""")


def ppr_t1(ctx: RunContext) -> str:
    from ..plans.ppr import METRICS, report_columns

    cols = report_columns(ctx)
    vals = ", ".join(
        f"({o}, {_q(desc)}, {('NULL' if key is None else _q(str(key)))}, {_q(year)})" for o, desc, key, year in cols)
    monthly = _ppr_metrics("ppm_m", "CAST(month AS VARCHAR)")
    totals = _ppr_metrics("ppm_m", "time_period")
    w = "OVER (PARTITION BY g.h_id, g.species, g.report_name ORDER BY g.column_order)"

    def pc(m):
        l1, l2 = f"lag(v.{m}, 1) {w}", f"lag(v.{m}, 2) {w}"
        chg = (f"CASE WHEN {l2} = 0 THEN 0.0 WHEN {l1} IS NULL OR {l1} = 0 THEN -1.0 "
               f"ELSE {ratio_round(f'{l1} - {l2}', l2, 3, 2, when_null=None)} END")
        return (f"coalesce(CASE WHEN g.column_order IN (3, 6, 9, 12) THEN {chg} "
                f"ELSE coalesce(CAST(v.{m} AS DOUBLE), 0.0) END, 0.0) AS {m}")

    final = f"""SELECT g.h_id, g.species, g.report_name,
  CASE WHEN g.column_order <= 3 THEN 'Summary Totals: ' || g.descr ELSE g.descr END AS report_month,
  g.column_order, {', '.join(pc(m) for m in METRICS)}, g.report_year_desc, {d(ctx.end_date)} AS end_date
FROM (SELECT c.h_id, s.species, mk.report_name, rc.column_order, rc.descr, rc.col_key, rc.report_year_desc
      FROM clinics c, (VALUES ('Canine'), ('Feline')) s(species), (VALUES ('Flea/Tick'), ('Heartworm')) mk(report_name),
           (VALUES {vals}) rc(column_order, descr, col_key, report_year_desc)) g
LEFT JOIN (SELECT *, CASE WHEN vi_species_id = 3 THEN 'Canine' ELSE 'Feline' END AS species
           FROM ({monthly} UNION ALL {totals})) v
  ON v.h_id = g.h_id AND v.species = g.species AND v.report_name = g.report_name AND v.col_key = g.col_key"""
    return with_ctes(*ppr_ctes(ctx), final=final)


def ppr_patient_period_cte(ctx: RunContext) -> str:
    return """ppp AS (
  SELECT time_period, substr(time_period, 7, 4) AS report_year, g.h_id, patient_id,
    CASE WHEN vi_species_id = 3 THEN 'Canine' ELSE 'Feline' END AS species, report_name, doses, rev, rec,
    CASE WHEN rec - doses < 0 THEN 0 WHEN rec - doses > rec THEN rec ELSE rec - doses END AS missed_doses,
    rec > doses AS non_compliant
  FROM (SELECT m.time_period, m.h_id, m.patient_id, m.vi_species_id, m.report_name,
          sum(coalesce(m.doses, 0)) AS doses, sum(m.rev) AS rev,
          coalesce(CASE WHEN m.report_name = 'Heartworm' THEN CASE WHEN m.vi_species_id = 3 THEN c.dose_rec_hw_dog ELSE c.dose_rec_hw_cat END
                        ELSE CASE WHEN m.vi_species_id = 3 THEN c.dose_rec_ft_dog ELSE c.dose_rec_ft_cat END END, 0) AS rec
        FROM ppm_m m LEFT JOIN clinics c ON c.h_id = m.h_id
        GROUP BY m.time_period, m.h_id, m.patient_id, m.vi_species_id, m.report_name, rec) g)"""


def ppr_t2(ctx: RunContext) -> str:
    years = ", ".join(f"('{p[0][6:10]}')" for p in ppr_periods(ctx))
    rec = ("coalesce(CASE WHEN g.report_name = 'Heartworm' THEN CASE WHEN g.species = 'Canine' THEN c.dose_rec_hw_dog ELSE c.dose_rec_hw_cat END "
           "ELSE CASE WHEN g.species = 'Canine' THEN c.dose_rec_ft_dog ELSE c.dose_rec_ft_cat END END, 0)")
    final = f"""SELECT g.h_id, g.species, g.report_name, g.report_year, CAST(g.doses_received AS BIGINT) AS doses_received,
  CAST(CASE WHEN {rec} - g.doses_received < 0 THEN 0 ELSE {rec} - g.doses_received END AS BIGINT) AS missed_doses,
  coalesce(a.unique_patients, 0) AS unique_patients, CAST(coalesce(a.total_missed_doses, 0) AS BIGINT) AS total_missed_doses
FROM (SELECT c.h_id, s.species, mk.report_name, y.report_year, dr.doses_received
      FROM clinics c, (VALUES ('Canine'), ('Feline')) s(species), (VALUES ('Flea/Tick'), ('Heartworm')) mk(report_name),
           (VALUES {years}) y(report_year), range(14) dr(doses_received)) g
JOIN clinics c ON c.h_id = g.h_id
LEFT JOIN (SELECT h_id, species, report_name, report_year,
             CASE WHEN doses < 0 THEN 0 WHEN doses <= 12 THEN doses ELSE 13 END AS doses_received,
             count(DISTINCT patient_id) AS unique_patients, sum(missed_doses) AS total_missed_doses
           FROM ppp GROUP BY 1, 2, 3, 4, 5) a
  ON a.h_id = g.h_id AND a.species = g.species AND a.report_name = g.report_name AND a.report_year = g.report_year
  AND a.doses_received = g.doses_received"""
    return with_ctes(*ppr_ctes(ctx), ppr_patient_period_cte(ctx), final=final)


def ppr_t4(ctx: RunContext) -> str:
    years = ", ".join(f"('{p[0][6:10]}')" for p in ppr_periods(ctx))
    final = f"""SELECT g.h_id, g.report_year AS time_period, g.species, g.report_name, 'Total ' || g.report_year AS report_time_period,
  coalesce(count(DISTINCT CASE WHEN p.non_compliant THEN p.patient_id END), 0) AS non_compliant_patients,
  CAST(coalesce(sum(p.missed_doses), 0) AS BIGINT) AS total_missed_doses,
  {ratio_round('sum(p.rev)', 'sum(p.doses)', 2, 2)} AS avg_price_per_dose,
  {ratio_round('sum(p.missed_doses) * sum(p.rev)', 'sum(p.doses)', 2, 2)} AS pot_addl_rev,
  CAST(coalesce(sum(p.rev), 0) AS DOUBLE) AS actual_rev
FROM (SELECT c.h_id, y.report_year, s.species, mk.report_name
      FROM clinics c, (VALUES {years}) y(report_year), (VALUES ('Canine'), ('Feline')) s(species),
           (VALUES ('Flea/Tick'), ('Heartworm')) mk(report_name)) g
LEFT JOIN ppp p ON p.h_id = g.h_id AND p.report_year = g.report_year AND p.species = g.species AND p.report_name = g.report_name
GROUP BY 1, 2, 3, 4, 5"""
    return with_ctes(*ppr_ctes(ctx), ppr_patient_period_cte(ctx), final=final)


def ppr_t5(ctx: RunContext) -> str:
    src = """SELECT h_id, 'Heartworm' AS report_name, CASE WHEN vi_species_id = 3 THEN 'Canine' ELSE 'Feline' END AS species,
      time_period, family_name, doses FROM ppm2 WHERE type IN ('fh', 'h')
    UNION ALL
    SELECT h_id, 'Flea/Tick', CASE WHEN vi_species_id = 3 THEN 'Canine' ELSE 'Feline' END, time_period, family_name, doses
    FROM ppm2 WHERE type IN ('fh', 'ft')"""
    cell = "h_id, report_name, species, time_period"
    fam = f"""SELECT {cell}, family_name, qty,
      {sr('qty', f'CASE WHEN sum(qty) OVER (PARTITION BY {cell}) = 0 THEN 1 ELSE sum(qty) OVER (PARTITION BY {cell}) END', 3)} AS pct
    FROM (SELECT {cell}, family_name, sum(doses) AS qty FROM ({src}) GROUP BY {cell}, family_name)"""
    r1 = f"dense_rank() OVER (PARTITION BY {cell} ORDER BY CASE WHEN family_name IN {PRIO} THEN 1 ELSE 2 END, qty DESC, family_name)"
    r2 = f"dense_rank() OVER (PARTITION BY {cell} ORDER BY qty DESC, family_name)"
    ranked = f"""SELECT {cell}, pct, CASE WHEN {r1} >= 6 THEN 'Other ' || report_name ELSE family_name END AS fam,
      least({r1}, 6) AS row_order, least({r2}, 6) AS mrank FROM ({fam})"""
    g = f"SELECT {cell}, fam, sum(pct) AS units, min(row_order) AS row_order, min(mrank) AS mrank FROM ({ranked}) GROUP BY {cell}, fam"
    s = f"sum(units) OVER (PARTITION BY {cell})"
    final = f"""SELECT {cell}, CASE WHEN fam LIKE 'Other%' THEN fam ELSE upper(fam) || '®' END AS product_name,
  CAST(row_order AS BIGINT) AS row_order,
  (CASE WHEN mrank = 1 AND {s} <> 1000 THEN units + (1000 - {s}) ELSE units END) / 1000.0 AS dose_pct
FROM ({g})"""
    return with_ctes(*ppr_ctes(ctx), ppr_pm2_cte(ctx), final=final)


# ------------------------------------------------------------ LAST DOSE
def ld_ctes(ctx: RunContext) -> list[str]:
    from ..operators import contact as cl

    flag = ctx.end_date.year - 1995
    fallback = add_months(ctx.end_date, -12)
    name = lambda c: f"coalesce({_strip(_strip(c, RE_NAME_JUNK), RE_NAME_CHARS)}, 'None Given')"
    addr = lambda c: _strip(_strip(c, RE_ADDR_JUNK), RE_CNTRL)

    def isin(c, vals):
        return f"upper({c}) IN ({', '.join(_q(v) for v in vals)})"

    def infix(c, parts):
        return "(" + " OR ".join(f"contains(upper({c}), {_q(p)})" for p in parts) + ")"

    more = cl.EXTRA_PLACEHOLDERS
    deny = " OR ".join([
        isin("first_name", cl.FIRST_NAME_EXACT), infix("first_name", cl.NAME_INFIX),
        isin("last_name", cl.LAST_NAME_EXACT + more), infix("last_name", cl.NAME_INFIX),
        isin("address1", cl.ADDRESS1_EXACT + more), "contains(upper(address1), '*')",
        isin("address2", cl.ADDRESS2_EXACT + cl.EXTRA_ADDRESS2), infix("address2", cl.ADDRESS2_INFIX),
        "(upper(first_name) = 'CASH' AND upper(last_name) IN ('CLIENT', 'CASH'))",
    ])
    fams = ", ".join(str(x) for x in b.EXCUSED_SURGERY_FAMILIES)
    prods = ", ".join(_q(x) for x in b.NSAID_PRODUCTS)
    end_excl = add_months(ctx.end_date, 1)
    mdvv = _case("n.product", b.NSAID_MIN_DVV)
    return [
        pw_cte(ctx, dogs_only=False, max_weight=500, months_active=24, code_filter=True, name="ldp", age_digits=6),
        f"""hist AS (
  SELECT p.h_id, p.h_id * 100 + (year(l.invoice_date) - 1995) AS run_id, year(l.invoice_date) - 1995 AS update_flag,
         l.client_id, l.patient_id, p.vi_species_id, l.invoice_date
  FROM lines l JOIN patients p ON p.patient_id = l.patient_id
  WHERE l.invoice_date < {d(ctx.end_date.replace(month=1, day=1))} AND NOT l.voided AND l.quantity_norm <> 0
    AND l.service_id IN (SELECT service_id FROM products WHERE type IS NOT NULL))""",
        f"""ld_start AS (
  SELECT c.h_id, coalesce(r.last_delivered + 1, {d(fallback)}) AS start_date
  FROM clinics c LEFT JOIN (
    SELECT h_id, max(invoice_date) AS last_delivered FROM hist
    WHERE run_id = (SELECT max(run_id) FROM hist h2 WHERE h2.h_id = hist.h_id AND h2.update_flag < {flag})
    GROUP BY h_id) r ON r.h_id = c.h_id)""",
        f"""ld_cli AS (
  SELECT * FROM (
    SELECT c.client_id, c.h_id, {name('c.first_name')} AS first_name, {name('c.last_name')} AS last_name,
      {_strip('c.title', RE_CNTRL)} AS prefix,
      coalesce({addr('c.address1')}, 'None Given') AS address1, {addr('c.address2')} AS address2,
      {_strip('c.city', RE_CNTRL)} AS city, {_strip('c.state', RE_CNTRL)} AS state,
      {_strip("lpad(substr(CASE WHEN regexp_matches(c.postal_code, '[^0-9]') THEN nullif(regexp_replace(c.postal_code, '[^0-9]', '', 'g'), '') ELSE c.postal_code END, 1, 9), 30, ' ')", RE_CNTRL)} AS postal_code,
      {_strip("substr(CASE WHEN regexp_matches(c.phone1, '[^0-9]') THEN nullif(regexp_replace(c.phone1, '[^0-9]', '', 'g'), '') ELSE c.phone1 END, 1, 10)", RE_CNTRL)} AS phone1,
      replace({_strip('c.primary_email', RE_NAME_CHARS)}, chr(10), ' ') AS primary_email,
      h.dogs_over_6, CAST(h.dogs_over_4 AS BIGINT) AS dogs_over_4, h.puppy, h.canines, h.felines, h.first_visit
    FROM clients c JOIN (
      SELECT client_id, max(dogs_over_6) AS dogs_over_6, sum(dogs_over_4) AS dogs_over_4, max(puppy) AS puppy,
        count(DISTINCT CASE WHEN vi_species_id = 3 THEN patient_id END) AS canines,
        count(DISTINCT CASE WHEN vi_species_id = 7 THEN patient_id END) AS felines,
        min(first_active) AS first_visit
      FROM ldp GROUP BY client_id) h ON h.client_id = c.client_id
    WHERE c.enabled = '1' AND coalesce(c.pms_client_code, 2) IN (2, 3, 4))
  WHERE NOT coalesce(state IS NULL OR city IS NULL
      OR regexp_matches(upper(state), '^(AB|BC|MB|NB|NL|NT|NS|NU|ON|PE|QC|SK|YT|PR)')
      OR postal_code IS NULL OR postal_code LIKE '%0000%' OR postal_code IN ('000000', '0', '00', '000')
      OR {deny}, false))""",
        _matrix_cte(),
        f"""ld_pur AS (
  SELECT 'L-' || CASE WHEN x.l_orderkey < 1 THEN 4294967297 - x.l_orderkey ELSE x.l_orderkey END || '-' || x.l_linenumber || '-' || x.l_partkey || '-' || x.l_suppkey AS lineitem_id, x.patient_id, x.client_id, x.h_id, x.invoice_date, x.product_info AS product,
    CAST({_doses_sql()} AS DECIMAL(18,4)) AS quantity, CAST(x.cost AS DECIMAL(18,4)) AS cost,
    CAST({_doses_sql()} AS DECIMAL(18,4)) AS pills,
    CASE WHEN EXISTS (SELECT 1 FROM appointments a WHERE a.patient_id = x.patient_id AND a.appointment_date = x.invoice_date)
         THEN 'Y' ELSE 'N' END AS appointment_flag, 'DENTALHYGIENE' AS type
  FROM (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.patient_id, l.client_id, l.invoice_date, l.cost, p.h_id, CAST(l.quantity AS BIGINT) AS quantity,
               pk.product_info, pk.package_quantity, pk.pkg_size, pk.pkg_volume
        FROM lines l JOIN ({_pkg_sql("product_info IN ('Surgery - dental', 'Service - Grooming')")}) pk ON pk.service_id = l.service_id
        JOIN ldp p ON p.patient_id = l.patient_id JOIN ld_start s ON s.h_id = p.h_id
        WHERE NOT l.voided AND l.quantity_norm <> 0 AND l.invoice_date < {d(end_excl)}
          AND l.invoice_date >= CAST(date_trunc('month', s.start_date) AS DATE)) x
  UNION ALL
  SELECT 'L-' || CASE WHEN l.l_orderkey < 1 THEN 4294967297 - l.l_orderkey ELSE l.l_orderkey END || '-' || l.l_linenumber || '-' || l.l_partkey || '-' || l.l_suppkey AS lineitem_id, l.patient_id, p.client_id, p.h_id, l.invoice_date, pr.family_name AS product,
    CAST(l.quantity_norm AS DECIMAL(18,4)) AS quantity, CAST(l.cost AS DECIMAL(18,4)) AS cost,
    CAST(NULL AS DECIMAL(18,4)) AS pills,
    CASE WHEN EXISTS (SELECT 1 FROM appointments a WHERE a.patient_id = l.patient_id AND a.appointment_date = l.invoice_date)
         THEN 'Y' ELSE 'N' END AS appointment_flag, pr.type
  FROM lines l JOIN products pr ON pr.service_id = l.service_id AND pr.type IS NOT NULL
  JOIN ldp p ON p.patient_id = l.patient_id JOIN ld_start s ON s.h_id = p.h_id
  WHERE NOT l.voided AND l.quantity_norm <> 0 AND l.invoice_date < {d(end_excl)}
    AND l.invoice_date >= CAST(date_trunc('month', s.start_date) AS DATE)
  UNION ALL
  SELECT 'E-' || CASE WHEN n.lineitem_id < 1 THEN 4294967297 - n.lineitem_id ELSE n.lineitem_id END AS lineitem_id, n.patient_id, p.client_id, p.h_id, n.invoice_date, n.product,
    CAST(CASE WHEN n.quantity IS NULL OR n.quantity = 0 THEN 1 ELSE n.quantity END AS DECIMAL(18,4)),
    CAST(CASE WHEN n.cost IS NULL THEN n.cost WHEN n.cost = 0 THEN 1 ELSE n.cost END AS DECIMAL(18,4)),
    CAST(CASE WHEN coalesce({sr('n.quantity', 'CASE WHEN n.dosage_volume IS NULL OR n.dosage_volume = 0 THEN 1 ELSE n.dosage_volume END', 0)}, 1) = 0 THEN 1
              ELSE coalesce({sr('n.quantity', 'CASE WHEN n.dosage_volume IS NULL OR n.dosage_volume = 0 THEN 1 ELSE n.dosage_volume END', 0)}, 1) END AS DECIMAL(18,4)),
    CASE WHEN EXISTS (SELECT 1 FROM appointments a WHERE a.patient_id = n.patient_id AND a.appointment_date = n.invoice_date)
         THEN 'Y' ELSE 'N' END, 'NSAID'
  FROM nsaid_sales n JOIN ldp p ON p.patient_id = n.patient_id JOIN ld_start s ON s.h_id = p.h_id
  WHERE NOT n.voided AND n.invoice_date < {d(end_excl)} AND n.product IN ({prods}) AND n.cost <> 0
    AND (({mdvv} <> 0 AND n.quantity IS NOT NULL AND n.quantity <> 0) OR {mdvv} = 0)
    AND n.invoice_date >= CAST(date_trunc('month', s.start_date) AS DATE)
    AND NOT ((n.quantity IS NULL OR n.quantity < 10 * CASE WHEN n.dosage_volume IS NULL OR n.dosage_volume = 0 THEN 1 ELSE n.dosage_volume END) AND EXISTS (
      SELECT 1 FROM surgeries g WHERE g.patient_id = n.patient_id AND g.surgery_family IN ({fams}) AND g.cost > 0
        AND n.invoice_ts BETWEEN g.surgery_ts - INTERVAL 5 DAY AND g.surgery_ts + INTERVAL 5 DAY)))""",
    ]


def last_dose_start(ctx: RunContext) -> str:
    return with_ctes(*ld_ctes(ctx), final="SELECT * FROM ld_start")


def last_dose_clients(ctx: RunContext) -> str:
    return with_ctes(*ld_ctes(ctx), final="SELECT * FROM ld_cli")


def last_dose_file(ctx: RunContext) -> str:
    mb = months_between(d(ctx.end_date), "pa.dob")
    detail = f"""SELECT DISTINCT '2DT' AS record_type,
    u.lineitem_id,
    CAST(c.client_id AS VARCHAR) AS client_id, substr(c.first_name, 1, 30) AS first_name, substr(c.last_name, 1, 30) AS last_name,
    substr(c.address1, 1, 40) AS address1, substr(c.address2, 1, 40) AS address2, substr(c.city, 1, 30) AS city,
    substr(c.state, 1, 2) AS state, trim(c.postal_code) AS postal_code,
    CASE WHEN regexp_matches(c.primary_email, {_q('(?i)^[A-Z0-9._%+-]+@[A-Z0-9.-]+[.][A-Z]{2,4}$')}) THEN c.primary_email END AS primary_email,
    CAST(c.canines AS BIGINT) AS canines, CAST(c.felines AS BIGINT) AS felines,
    {_mdy('u.invoice_date')} AS invoice_date,
    CASE WHEN u.type IN ('fh', 'fth') THEN 'COMBO' WHEN u.type IN ('f', 'ft') THEN 'FLEATICK' WHEN u.type = 'h' THEN 'HEARTWORM' ELSE u.type END AS product_category,
    u.product AS family_name,
    CAST(round(CASE WHEN u.type <> 'NSAID' THEN u.quantity ELSE u.pills END, 1) AS DOUBLE) AS quantity_norm,
    {_money('u.cost')} AS cost_norm, u.appointment_flag AS appointment, c.h_id,
    CAST(CASE WHEN pa.vi_species_id = 3 AND u.product = 'Previcox' THEN u.pills END AS DOUBLE) AS pills,
    CAST(CASE WHEN pa.vi_species_id = 3 THEN least(greatest(floor({mb} / 12), 0), 99) END AS BIGINT) AS age_years,
    CAST(CASE WHEN pa.vi_species_id = 3 THEN round(p.weight, 0) END AS DOUBLE) AS weight,
    CAST(c.dogs_over_4 AS BIGINT) AS dogs_over_4
  FROM ld_cli c JOIN ld_pur u ON u.client_id = c.client_id
  JOIN ldp p ON p.patient_id = u.patient_id JOIN patients pa ON pa.patient_id = u.patient_id"""
    cols = ["record_type", "lineitem_id", "client_id", "first_name", "last_name", "address1", "address2", "city",
            "state", "postal_code", "primary_email", "canines", "felines", "invoice_date", "product_category",
            "family_name", "quantity_norm", "cost_norm", "appointment", "h_id", "pills", "age_years", "weight",
            "dogs_over_4"]
    types = {"canines": "BIGINT", "felines": "BIGINT", "quantity_norm": "DOUBLE", "pills": "DOUBLE",
             "age_years": "BIGINT", "weight": "DOUBLE", "dogs_over_4": "BIGINT"}

    def row(vals):
        return ", ".join(f"{vals.get(c, 'CAST(NULL AS ' + types.get(c, 'VARCHAR') + ')')} AS {c}" for c in cols)

    head = {"record_type": "'1HD'", "lineitem_id": f"'{ctx.as_of.strftime('%m/%d/%Y')}'", "client_id": "account_number",
            "address1": f"'{run_flag(ctx) + 1}'", "address2": f"'{ctx.end_date.year}'", "city": "'PH'",
            "first_name": "CAST(location_number AS VARCHAR)", "last_name": "substr(clinic_name, 1, 40)", "h_id": "h_id"}
    trail = {"record_type": "'3TR'", "lineitem_id": "CAST(coalesce(n.n, 0) + 2 AS VARCHAR)", "h_id": "c.h_id"}
    final = f"""SELECT * FROM ({detail})
UNION ALL SELECT {row(head)} FROM clinics
UNION ALL SELECT {row(trail)} FROM clinics c LEFT JOIN (SELECT h_id, count(*) AS n FROM ({detail}) GROUP BY h_id) n ON n.h_id = c.h_id"""
    return with_ctes(*ld_ctes(ctx), final=final)


def newly_inactive(ctx: RunContext) -> str:
    flag = run_flag(ctx)
    final = f"""SELECT b.h_id, c.location_number, b.client_id, {ctx.end_date.year} AS report_year, {flag} AS update_flag
FROM (SELECT DISTINCT h.h_id, h.client_id FROM hist h
      WHERE h.update_flag < {flag}
        AND h.run_id = (SELECT max(run_id) FROM hist x WHERE x.h_id = h.h_id AND x.update_flag = h.update_flag)
        AND EXISTS (SELECT 1 FROM hist dog WHERE dog.run_id = h.run_id AND dog.client_id = h.client_id AND dog.vi_species_id = 3)) b
JOIN clinics c ON c.h_id = b.h_id
LEFT JOIN (SELECT client_id FROM ld_cli WHERE canines <> 0) a ON a.client_id = b.client_id
WHERE a.client_id IS NULL"""
    return with_ctes(*ld_ctes(ctx), final=final)


# ---------------------------------------------------------- dims / text
def merge_enrollment(ctx: RunContext, always: bool = False) -> str:
    t = """SELECT s_suppkey AS location_number, s_name AS account_name, CAST(s_nationkey AS BIGINT) AS nation_key,
    CAST(CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE s_acctbal END AS DECIMAL(18,2)) AS balance,
    DATE '2000-01-01' AS last_update FROM supplier WHERE s_suppkey % 4 <> 3"""
    s = """SELECT s_suppkey AS location_number,
    CASE WHEN s_suppkey % 5 = 0 THEN s_name || ' v2' ELSE s_name END AS account_name,
    CAST(CASE WHEN s_suppkey % 13 = 0 THEN (s_nationkey + 1) % 25 ELSE s_nationkey END AS BIGINT) AS nation_key,
    CAST(CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_acctbal END AS DECIMAL(18,2)) AS balance
  FROM supplier WHERE s_suppkey % 4 <> 0"""
    chg = "true" if always else " OR ".join(f"coalesce(t.{c} <> s.{c}, false)" for c in ("account_name", "nation_key", "balance"))
    return f"""WITH t AS ({t}), s AS ({s})
SELECT coalesce(t.location_number, s.location_number) AS location_number,
  CASE WHEN t.location_number IS NULL OR (s.location_number IS NOT NULL AND ({chg})) THEN s.account_name ELSE t.account_name END AS account_name,
  CASE WHEN t.location_number IS NULL OR (s.location_number IS NOT NULL AND ({chg})) THEN s.nation_key ELSE t.nation_key END AS nation_key,
  CAST(CASE WHEN t.location_number IS NULL OR (s.location_number IS NOT NULL AND ({chg})) THEN s.balance ELSE t.balance END AS DOUBLE) AS balance,
  CASE WHEN t.location_number IS NULL OR (s.location_number IS NOT NULL AND ({chg})) THEN {d(ctx.as_of)} ELSE t.last_update END AS last_update,
  CASE WHEN t.location_number IS NULL THEN 'insert' WHEN s.location_number IS NULL THEN 'keep'
       WHEN {chg} THEN 'update' ELSE 'keep' END AS action
FROM t FULL OUTER JOIN s ON t.location_number = s.location_number"""


def refresh_enrollment(ctx: RunContext) -> str:
    return merge_enrollment(ctx, always=True)


def run_states(ctx: RunContext) -> str:
    return """WITH log AS (
  SELECT user_id AS run_id,
    CASE event_type WHEN 'signup' THEN 'RUNID' WHEN 'view' THEN 'STARTED' WHEN 'purchase' THEN 'SUCCESS'
                    WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS flag,
    'RUN_CLINIC' AS process, CAST(ts AS DATE) AS end_date, value FROM events),
open_runs AS (SELECT DISTINCT run_id FROM (
  SELECT run_id, process, end_date FROM log WHERE flag = 'STARTED'
  EXCEPT SELECT run_id, process, end_date FROM log WHERE flag IN ('SUCCESS', 'ERROR', 'INFO')))
SELECT c_custkey AS run_id,
  CASE WHEN c_custkey NOT IN (SELECT run_id FROM log WHERE flag = 'RUNID') THEN 'unknown'
       WHEN c_custkey IN (SELECT run_id FROM log WHERE flag = 'SUCCESS' AND value > 45) THEN 'already_run'
       WHEN c_custkey IN (SELECT run_id FROM open_runs) THEN 'in_progress'
       ELSE 'ok' END AS state
FROM customer"""


def readiness(ctx: RunContext, months_back: int = 12) -> str:
    lo, hi = ctx.months_window(-(months_back - 1), 0)
    ratio = ratio_round("g.cats_dogs_total", "g.total_patients", 4)
    share = ratio_round("g.patient_0", "g.total_rows", 4, when_zero="NULL")
    return with_ctes(final=f"""SELECT c.h_id,
  CAST(CASE WHEN {months_back} - coalesce(g.month_count, 0) > 0 THEN {months_back} - coalesce(g.month_count, 0) END AS BIGINT) AS missing_months,
  CASE WHEN coalesce(g.total_patients, 0) = 0 THEN 0.0 WHEN {ratio} > 0.5 THEN NULL ELSE {ratio} END AS missing_species,
  CASE WHEN {share} < 0.2 THEN NULL ELSE {share} END AS pat_id_0,
  CAST(CASE WHEN c.h_id % 5 <> 1 THEN c.h_id % 5 END AS BIGINT) AS status_not_1
FROM clinics c LEFT JOIN (
  SELECT p.h_id, count(DISTINCT date_trunc('month', l.invoice_date)) AS month_count,
    count(DISTINCT CASE WHEN p.vi_species_id IN (3, 7) THEN p.patient_id END) AS cats_dogs_total,
    count(DISTINCT p.patient_id) AS total_patients,
    sum(CASE WHEN l.patient_id = 0 THEN 1 ELSE 0 END) AS patient_0, count(*) AS total_rows
  FROM lines l JOIN patients p ON p.patient_id = l.patient_id
  WHERE l.invoice_date >= {d(lo)} AND l.invoice_date < {d(hi)}
  GROUP BY p.h_id) g ON g.h_id = c.h_id""")


def _kw(c: str, terms) -> str:
    from ..operators.keywords import alternation

    return f"regexp_matches(lower(regexp_replace({c}, {_q(chr(92) + '{.*' + chr(92) + '}')}, '', 'g')), {_q(alternation(terms))})"


def wellness_by_keywords(ctx: RunContext) -> str:
    from ..operators.keywords import EXCLUDE_TERMS, INCLUDE_TERMS

    inc = f"(coalesce({_kw('handle', INCLUDE_TERMS)}, false) OR coalesce({_kw('descr', INCLUDE_TERMS)}, false))"
    exc = f"(coalesce({_kw('handle', EXCLUDE_TERMS)}, false) OR coalesce({_kw('descr', EXCLUDE_TERMS)}, false))"
    return f"""SELECT hid, count(*) AS services, count(CASE WHEN {inc} AND NOT {exc} THEN 1 END) AS wellness_services,
  count(CASE WHEN {_kw('descr', INCLUDE_TERMS)} THEN 1 END) AS include_hits
FROM (SELECT doc_id AS id, doc_id % 25 AS hid, concat_ws(' ', lang, source) AS handle, text AS descr FROM documents)
GROUP BY hid"""


def pii_shapes(ctx: RunContext) -> str:
    from ..operators import contact as cl

    email = "regexp_extract(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,4}', 0)"
    return f"""SELECT source, count(*) AS docs,
  count(CASE WHEN coalesce(regexp_matches(text, {_q(cl.PHONE_SHAPE)}), false) THEN 1 END) AS with_phone,
  count(CASE WHEN coalesce(regexp_matches(text, {_q(cl.CARD_SHAPE)}), false) THEN 1 END) AS with_card,
  count(CASE WHEN coalesce(regexp_matches(text, {_q(cl.DIGIT_RUN)}), false) THEN 1 END) AS with_digit_run,
  count(CASE WHEN regexp_matches({email}, {_q('(?i)^[A-Z0-9._%+-]+@[A-Z0-9.-]+[.][A-Z]{2,4}$')}) THEN 1 END) AS with_email
FROM documents GROUP BY source"""


def recipient_lists(ctx: RunContext) -> str:
    return """SELECT project, string_agg(email_addr, ',' ORDER BY email_addr) AS email_list
FROM (SELECT 'conv-' || CAST(conv_id AS VARCHAR) AS project,
        role || '.' || CAST(turn AS VARCHAR) || '@example.com' AS email_addr,
        CASE WHEN turn % 3 <> 2 THEN 'Y' ELSE 'N' END AS active_ind FROM conversations)
WHERE active_ind = 'Y' GROUP BY project"""


def token_profile(ctx: RunContext) -> str:
    delim = ("CASE WHEN instr(trim(text), ',') > 0 THEN ',' WHEN instr(trim(text), '|') > 0 THEN '|' "
             "WHEN instr(trim(text), ' ') > 0 THEN ' ' END")
    parts = (f"CASE WHEN text IS NULL OR trim(text) = '' THEN CAST([] AS VARCHAR[]) "
             f"WHEN {delim} = ',' THEN string_split(trim(text), ',') WHEN {delim} = '|' THEN string_split(trim(text), '|') "
             f"WHEN {delim} = ' ' THEN regexp_split_to_array(trim(text), ' +') ELSE [trim(text)] END")
    return f"""WITH src AS (
  SELECT 'benchmark' AS src, item_id AS id, text FROM benchmark
  UNION ALL SELECT 'documents', doc_id, text FROM documents),
a AS (SELECT src, id, {delim} AS delimiter, list_transform({parts}, lambda x: trim(x)) AS t FROM src),
b AS (SELECT src, id, delimiter,
        list_transform(CASE WHEN len(t) > 1 AND t[len(t)] = '' THEN list_slice(t, 1, len(t) - 1) ELSE t END,
                       lambda x: nullif(x, '')) AS tokens FROM a)
SELECT src, id, coalesce(delimiter, 'none') AS delimiter, CAST(len(tokens) AS BIGINT) AS n_tokens,
  CAST(len(list_filter(tokens, lambda x: x IS NULL)) AS BIGINT) AS n_empty,
  CAST(coalesce(list_max(list_transform(tokens, lambda x: length(x))), 0) AS BIGINT) AS max_token_len,
  tokens[1] AS first_token
FROM b"""


# -------------------------------------------------------------- CONTROL
def control_cte(ctx: RunContext) -> str:
    end, as_of = ctx.end_date, ctx.as_of
    lo = max(add_months(end, -24), add_months(as_of, -24))
    hi = min(add_months(end, 1), as_of)
    return f"""ctl AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.patient_id, l.client_id, l.invoice_date,
    l.quantity_norm, l.quantity AS line_quantity, l.cost, p.h_id, p.vi_species_id, pr.product, pr.family_name, pr.type, pr.service_kind,
    pr.product_info, c.start_date, {d(end)} AS end_day, coalesce(p.is_active AND NOT p.is_deceased AND p.vi_species_id IN (3, 7), false) AS in_control
  FROM lines l JOIN patients p ON p.patient_id = l.patient_id
  LEFT JOIN products pr ON pr.service_id = l.service_id JOIN clinics c ON c.h_id = p.h_id
  WHERE NOT l.voided AND l.client_id IS NOT NULL AND l.invoice_date >= {d(lo)} AND l.invoice_date < {d(hi)})"""


CONTROL_TAG_SQL = {
    "combo": "type IN ('fh', 'fth')",
    "hg": "product LIKE 'Heartgard%'",
    "fl": "product LIKE 'Frontline%' AND product NOT LIKE 'Frontline Tritak%'",
    "flt": "product LIKE 'Frontline Tritak%'",
    "ce": "product LIKE 'Certifect%'",
    "nex": "product LIKE 'NexGard%'",
    "comp_hg": "type = 'h' AND product NOT LIKE 'Heartgard%'",
    "comp_fl": "type IN ('f', 'ft') AND product NOT LIKE 'Frontline%' AND product NOT LIKE 'NexGard%' AND product NOT LIKE 'Certifect%'",
}


def _last_product(base: str, tag: str, camp: str) -> str:
    return f"""LEFT JOIN (SELECT client_id, arg_max(CASE WHEN {camp} THEN product ELSE '' END, row_no) AS p, nullif(p, '') AS prod
    FROM (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY {LINE_ORDER}) AS row_no FROM ({base}) WHERE {CONTROL_TAG_SQL[tag]})
    GROUP BY client_id) q_{tag} ON q_{tag}.client_id = c.client_id"""


# written from the reference's stages: every one joins the control clients' patients and needs a cost; medication counts months end-23..end
CONTROL_SERVICE_SQL = {
    "pm": "in_control AND cost <> 0 AND service_kind = 'nsaid' AND date_trunc('month', invoice_date) >= date_trunc('month', end_day) - INTERVAL 23 MONTH",
    "dental": "in_control AND cost <> 0 AND service_kind = 'general' AND product_info = 'Surgery - dental'",
    "surg": "in_control AND cost <> 0 AND service_kind = 'general' AND product_info LIKE 'Surgery%' AND product_info <> 'Surgery - dental'",
    "vacc": "in_control AND cost <> 0 AND service_kind = 'vaccine'",
    "board": "in_control AND cost <> 0 AND service_kind = 'general' AND lower(product_info) = 'service - boarding'",
    "groom": "in_control AND cost <> 0 AND service_kind = 'general' AND lower(product_info) = 'service - grooming'",
    "other": """in_control AND cost <> 0
      AND NOT coalesce(service_kind = 'general' AND (product_info LIKE 'Surgery%' OR lower(product_info) LIKE '%dental%'
        OR lower(product_info) IN ('service - boarding', 'service - grooming')), false)
      AND coalesce(service_kind, '') NOT IN ('diet', 'vaccine', 'nsaid')
      AND NOT coalesce(type IS NOT NULL AND quantity_norm <> 0, false)""",
}


def control_product_metrics(ctx: RunContext) -> str:
    camp = f"invoice_date BETWEEN start_date AND {d(ctx.as_of - timedelta(days=1))}"
    w12, w24 = ctx.trailing(0), ctx.trailing(1)
    base = "SELECT * FROM ctl WHERE in_control AND type IS NOT NULL AND quantity_norm IS NOT NULL AND quantity_norm <> 0"
    subs, cols = [], []
    for tag, pred in CONTROL_TAG_SQL.items():
        subs.append(f"""LEFT JOIN (
    SELECT client_id, max(invoice_date) AS last_{tag}_purch,
      count(DISTINCT CASE WHEN {camp} THEN (l_orderkey, l_linenumber, l_partkey, l_suppkey) END) AS {tag}_purch_camp,
      sum(CASE WHEN {camp} THEN cost END) AS {tag}_rev_camp,
      sum(CASE WHEN {camp} THEN quantity_norm END) AS {tag}_doses_camp,
      last(vi_species_id ORDER BY {LINE_ORDER}) AS {tag}_last_pet_species
    FROM ({base}) WHERE {pred} GROUP BY client_id) s_{tag} ON s_{tag}.client_id = c.client_id""")
        cols += [f"s_{tag}.last_{tag}_purch", f"coalesce(s_{tag}.{tag}_purch_camp, 0) AS {tag}_purch_camp",
                 f"CAST(s_{tag}.{tag}_rev_camp AS DOUBLE) AS {tag}_rev_camp",
                 f"CAST(s_{tag}.{tag}_doses_camp AS BIGINT) AS {tag}_doses_camp", f"s_{tag}.{tag}_last_pet_species"]
    other = f"""LEFT JOIN (SELECT client_id,
      sum(CASE WHEN product LIKE 'Interceptor%' AND {_between('invoice_date', w12)} THEN quantity_norm ELSE 0 END) AS int_doses_12,
      sum(CASE WHEN product LIKE 'Interceptor%' AND {_between('invoice_date', w24)} THEN quantity_norm ELSE 0 END) AS int_doses_24,
      sum(CASE WHEN product LIKE 'Interceptor%' AND {camp} THEN quantity_norm ELSE 0 END) AS int_doses_camp,
      sum(CASE WHEN family_name = 'Trifexis' AND {camp} THEN quantity_norm ELSE 0 END) AS trif_doses,
      sum(CASE WHEN family_name = 'Revolution' AND {camp} THEN quantity_norm ELSE 0 END) AS rev_doses,
      sum(CASE WHEN family_name = 'Advantage Multi' AND {camp} THEN quantity_norm ELSE 0 END) AS adv_doses
    FROM ({base}) GROUP BY client_id) s_o ON s_o.client_id = c.client_id"""
    cols += [f"CAST(s_o.{x} AS BIGINT) AS {x}" for x in
             ("int_doses_12", "int_doses_24", "int_doses_camp", "trif_doses", "rev_doses", "adv_doses")]
    for tag in ("comp_hg", "comp_fl"):
        cols.append(f"q_{tag}.prod AS {tag}_prod")
        subs.append(_last_product(base, tag, camp))
    final = (f"SELECT c.client_id, {', '.join(cols)}\nFROM (SELECT DISTINCT client_id FROM ({base})) c\n"
             + "\n".join(subs) + "\n" + other)
    return with_ctes(control_cte(ctx), final=final)


def control_service_metrics(ctx: RunContext) -> str:
    end = ctx.end_date
    camp = f"invoice_date BETWEEN start_date AND {d(ctx.as_of - timedelta(days=1))}"
    tags = CONTROL_SERVICE_SQL
    subs, cols = [], []
    for tag, pred in tags.items():
        subs.append(f"""LEFT JOIN (SELECT client_id, count(CASE WHEN {camp} THEN 1 END) AS n, max(invoice_date) AS last,
      sum(CASE WHEN {camp} THEN cost ELSE 0 END) AS dollars FROM ctl WHERE {pred} GROUP BY client_id) s_{tag}
    ON s_{tag}.client_id = c.client_id""")
        cols += [f"coalesce(s_{tag}.n, 0) AS num_{tag}_purch", f"s_{tag}.last AS last_{tag}_purch",
                 f"CAST(coalesce(s_{tag}.dollars, 0) AS DOUBLE) AS dollar_{tag}_purch"]
    final = f"""SELECT c.client_id, {', '.join(cols)}, c.num_visits, c.last_active, c.first_active
FROM (SELECT client_id,
        count(DISTINCT CASE WHEN invoice_date BETWEEN {d(add_months(end, -12))} AND {d(end)} THEN invoice_date END) AS num_visits,
        max(invoice_date) AS last_active, min(invoice_date) AS first_active
      FROM ctl GROUP BY client_id) c
""" + "\n".join(subs)
    return with_ctes(control_cte(ctx), final=final)


# --------------------------------------------------- call list / dental
def _dg(c: str) -> str:
    return f"nullif(regexp_replace({c}, '[^0-9]+', '', 'g'), '')"


def _pkg_sql(where: str) -> str:
    return f"""SELECT service_id, product_info,
      CASE WHEN package_size % 4 = 0 THEN CAST(package_size AS VARCHAR)
           WHEN package_size % 4 = 1 THEN CAST(package_size AS VARCHAR) || ' ct' END AS package_quantity,
      CASE WHEN package_size % 3 = 0 THEN 'small' WHEN package_size % 3 = 1 THEN 'large' END AS pkg_size,
      CASE WHEN package_size % 5 < 3 THEN CAST(package_size % 7 + 1 AS VARCHAR) || CASE WHEN package_size % 2 = 0 THEN ' oz' ELSE '' END END AS pkg_volume
    FROM products WHERE {where}"""


def _doses_sql(q: str = "x.quantity") -> str:
    uniq = "(SELECT CASE WHEN count(*) = 1 THEN max(m.package_count) END FROM m WHERE {cond})"
    t2 = uniq.format(cond=f"m.product = x.product_info AND {_dg('m.package_volume')} = {_dg('x.pkg_volume')} AND m.treat_size = x.pkg_size")
    t3 = uniq.format(cond=(f"m.product = x.product_info AND {_dg('m.package_volume')} = {_dg('x.pkg_volume')} AND "
                           f"(SELECT count(*) FROM m i WHERE i.product = x.product_info AND i.package_volume = {_dg('x.pkg_volume')}) = 1"))
    t4 = uniq.format(cond="m.product = x.product_info AND m.treat_size = x.pkg_size")
    return f"""CASE WHEN x.package_quantity IS NOT NULL THEN
        CASE WHEN x.package_quantity = CAST({q} AS VARCHAR) THEN CAST({_dg('x.package_quantity')} AS DECIMAL(18,4))
             WHEN TRY_CAST(x.package_quantity AS DECIMAL(18,4)) IS NOT NULL THEN TRY_CAST(x.package_quantity AS DECIMAL(18,4)) * {q}
             ELSE {q} END
      WHEN x.pkg_size IS NOT NULL AND x.pkg_volume IS NOT NULL AND {_dg('x.pkg_volume')} IS NOT NULL THEN coalesce({t2} * {q}, {q})
      WHEN {_dg('x.pkg_volume')} IS NOT NULL THEN coalesce({t3} * {q}, {q})
      WHEN x.pkg_size IS NOT NULL THEN coalesce({t4} * {q}, {q})
      ELSE {q} END"""


def _matrix_cte() -> str:
    from ..plans.calllist import dental_matrix_rows

    vals = ", ".join(f"({_q(p)}, {_q(s)}, {_q(v)}, {c})" for p, s, v, c in dental_matrix_rows())
    return f"m AS (SELECT * FROM (VALUES {vals}) v(product, treat_size, package_volume, package_count))"


def control_nsaid(ctx: RunContext) -> str:
    return with_ctes(final=control_nsaid_sql(ctx))


def control_nsaid_sql(ctx: RunContext, per_client: bool = False) -> str:
    lo, hi = ctx.months_window(-23, 0)
    camp = f"s.invoice_date BETWEEN c.start_date AND {d(ctx.as_of - timedelta(days=1))}"
    p9 = sr("s.quantity", "s.dosage_volume", 9)
    keys = "s.client_id" if per_client else "p.h_id, s.client_id"
    return f"""SELECT {keys},
  count(CASE WHEN {camp} THEN s.lineitem_id END) AS num_prev_purch, max(s.invoice_date) AS last_prev_purch,
  CAST(coalesce(sum(CASE WHEN {camp} THEN s.cost END), 0) AS DOUBLE) AS dollar_prev_purch,
  coalesce({sr(f'sum(CASE WHEN {camp} THEN {p9} END)', '1000000000', 2)}, 0) / 100.0 AS prev_pills,
  count(DISTINCT CASE WHEN {camp} AND p.vi_species_id = 3 THEN s.patient_id END) AS num_dogs
FROM nsaid_sales s JOIN patients p ON p.patient_id = s.patient_id JOIN clinics c ON c.h_id = p.h_id
WHERE s.product = 'Previcox' AND NOT s.voided AND s.cost <> 0 AND s.quantity IS NOT NULL AND s.quantity <> 0
  AND s.invoice_date >= {d(lo)} AND s.invoice_date < {d(hi)}
  AND p.is_active AND NOT p.is_deceased AND p.vi_species_id IN (3, 7)
GROUP BY {keys}"""


def control_dental_hygiene(ctx: RunContext) -> str:
    return with_ctes(control_cte(ctx), _matrix_cte(), final=control_dental_hygiene_sql(ctx))


def control_dental_hygiene_sql(ctx: RunContext, per_client: bool = False) -> str:
    from ..plans.control import DENTAL_HYG_GROUPS

    grp = _case("x.product_info", DENTAL_HYG_GROUPS)
    infos = ", ".join(_q(k) for k in DENTAL_HYG_GROUPS)
    camp = f"x.invoice_date BETWEEN x.start_date AND {d(ctx.as_of - timedelta(days=1))}"
    cols = []
    for name, g in (("oravet", "Oravet"), ("dental_hyg", "Competitive")):
        cols += [f"max(CASE WHEN grp = '{g}' THEN invoice_date END) AS last_{name}_purch",
                 f"count(CASE WHEN grp = '{g}' AND camp THEN 1 END) AS num_{name}_purch",
                 f"CAST(coalesce(sum(CASE WHEN grp = '{g}' AND camp THEN cost END), 0) AS DOUBLE) AS dollar_{name}_purch",
                 f"CAST(coalesce(sum(CASE WHEN grp = '{g}' AND camp THEN doses END), 0) AS DOUBLE) AS doses_{name}_purch"]
    keys = "client_id" if per_client else "h_id, client_id"
    return f"""SELECT {keys}, {', '.join(cols)}
FROM (SELECT x.h_id, x.client_id, x.invoice_date, x.cost, {grp} AS grp, {camp} AS camp, {_doses_sql()} AS doses
      FROM (SELECT ctl.*, CAST(ctl.line_quantity AS BIGINT) AS quantity, pk.package_quantity, pk.pkg_size, pk.pkg_volume
            FROM ctl JOIN ({_pkg_sql('product_info IS NOT NULL')}) pk ON pk.service_id = ctl.l_partkey
            WHERE ctl.in_control AND ctl.cost <> 0 AND ctl.product_info IN ({infos})) x)
GROUP BY {keys}"""


def dental_purchases(ctx: RunContext) -> str:
    from ..plans.calllist import DENTAL, dental_matrix_rows

    lo, hi = ctx.months_window(-11, 0)
    vals = ", ".join(f"({_q(p)}, {_q(s)}, {_q(v)}, {c})" for p, s, v, c in dental_matrix_rows())
    svc = f"""SELECT service_id, product_info,
      CASE WHEN package_size % 4 = 0 THEN CAST(package_size AS VARCHAR)
           WHEN package_size % 4 = 1 THEN CAST(package_size AS VARCHAR) || ' ct' END AS package_quantity,
      CASE WHEN package_size % 3 = 0 THEN 'small' WHEN package_size % 3 = 1 THEN 'large' END AS pkg_size,
      CASE WHEN package_size % 5 < 3 THEN CAST(package_size % 7 + 1 AS VARCHAR) || CASE WHEN package_size % 2 = 0 THEN ' oz' ELSE '' END END AS pkg_volume
    FROM products WHERE product_info = {_q(DENTAL)}"""
    uniq = "(SELECT CASE WHEN count(*) = 1 THEN max(m.package_count) END FROM m WHERE {cond})"
    t2 = uniq.format(cond=f"m.product = x.product_info AND {_dg('m.package_volume')} = {_dg('x.pkg_volume')} AND m.treat_size = x.pkg_size")
    t3 = uniq.format(cond=(f"m.product = x.product_info AND {_dg('m.package_volume')} = {_dg('x.pkg_volume')} AND "
                           f"(SELECT count(*) FROM m i WHERE i.product = x.product_info AND i.package_volume = {_dg('x.pkg_volume')}) = 1"))
    t4 = uniq.format(cond="m.product = x.product_info AND m.treat_size = x.pkg_size")
    q = "x.quantity"
    doses = f"""CASE WHEN x.package_quantity IS NOT NULL THEN
        CASE WHEN x.package_quantity = CAST({q} AS VARCHAR) THEN CAST({_dg('x.package_quantity')} AS DECIMAL(18,4))
             WHEN TRY_CAST(x.package_quantity AS DECIMAL(18,4)) IS NOT NULL THEN TRY_CAST(x.package_quantity AS DECIMAL(18,4)) * {q}
             ELSE {q} END
      WHEN x.pkg_size IS NOT NULL AND x.pkg_volume IS NOT NULL AND {_dg('x.pkg_volume')} IS NOT NULL THEN coalesce({t2} * {q}, {q})
      WHEN {_dg('x.pkg_volume')} IS NOT NULL THEN coalesce({t3} * {q}, {q})
      WHEN x.pkg_size IS NOT NULL THEN coalesce({t4} * {q}, {q})
      ELSE {q} END"""
    final = f"""SELECT client_id, count(*) AS dental_lines, CAST(sum(doses) AS DOUBLE) AS dental_doses,
  CAST(sum(cost) AS DOUBLE) AS dental_spend
FROM (SELECT x.client_id, x.cost, {doses} AS doses
      FROM (SELECT l.client_id, CAST(l.quantity AS BIGINT) AS quantity, l.cost, s.*
            FROM lines l JOIN ({svc}) s ON s.service_id = l.service_id
            WHERE NOT l.voided AND l.invoice_date >= {d(lo)} AND l.invoice_date < {d(hi)}) x)
GROUP BY client_id"""
    return with_ctes(f"m AS (SELECT * FROM (VALUES {vals}) v(product, treat_size, package_volume, package_count))", final=final)


def call_list(ctx: RunContext) -> str:
    from datetime import timedelta as _td

    end = ctx.end_date
    lo, hi = ctx.months_window(-11, 0)
    period = add_months(end, -11).strftime("%d-%b-%y") + " - " + (add_months(end, 1) - _td(days=1)).strftime("%d-%b-%y")
    phone = "regexp_replace(c.phone, '[() \\-]', '', 'g')"
    ctes = f"""up AS (SELECT patient_id, client_id, h_id, vi_species_id FROM patients
              WHERE is_active AND vi_species_id IN (3, 7) AND patient_id > 0),
fth AS (SELECT l.patient_id, up.client_id, up.vi_species_id, l.invoice_date, l.quantity_norm, pr.type
        FROM lines l JOIN products pr ON pr.service_id = l.service_id AND pr.type IS NOT NULL
        JOIN up ON up.patient_id = l.patient_id
        WHERE NOT l.voided AND l.cost <> 0 AND l.invoice_date >= {d(lo)} AND l.invoice_date < {d(hi)}
          AND NOT (pr.family_name = 'Certifect' AND date_trunc('month', l.invoice_date) < DATE '2011-07-01')),
cli AS (SELECT c.client_id, c.h_id,
          coalesce({_strip('c.first_name', RE_NAME_JUNK)}, 'None Given') AS first_name,
          coalesce({_strip('c.last_name', RE_NAME_JUNK)}, 'None Given') AS last_name,
          h.canines, h.felines, CASE WHEN c.primary_email = '0' THEN NULL ELSE c.primary_email END AS primary_email,
          substr(CASE WHEN regexp_matches(c.phone1, '[^0-9]') THEN nullif(regexp_replace(c.phone1, '[^0-9]', '', 'g'), '') ELSE c.phone1 END, 1, 10) AS phone
        FROM clients c JOIN (SELECT client_id, count(DISTINCT CASE WHEN vi_species_id = 3 THEN patient_id END) AS canines,
                                    count(DISTINCT CASE WHEN vi_species_id = 7 THEN patient_id END) AS felines
                             FROM up GROUP BY client_id) h ON h.client_id = c.client_id),
good AS (SELECT DISTINCT up.client_id FROM up LEFT JOIN (
           SELECT patient_id, sum(CASE WHEN type IN ('f','ft','fth','fh') THEN quantity_norm ELSE 0 END) AS ft,
                  sum(CASE WHEN type IN ('h','fth','fh') THEN quantity_norm ELSE 0 END) AS hw
           FROM fth GROUP BY patient_id) a ON a.patient_id = up.patient_id
         WHERE coalesce(a.ft, 0) < 6 OR coalesce(a.hw, 0) < 12),
lp AS (SELECT client_id,
         max(CASE WHEN vi_species_id = 3 AND type IN ('f','ft','fth','fh') THEN invoice_date END) AS ft_canine,
         max(CASE WHEN vi_species_id = 7 AND type IN ('f','ft','fth','fh') THEN invoice_date END) AS ft_feline,
         max(CASE WHEN vi_species_id = 3 AND type IN ('h','fth','fh') THEN invoice_date END) AS hw_canine,
         max(CASE WHEN vi_species_id = 7 AND type IN ('h','fth','fh') THEN invoice_date END) AS hw_feline
       FROM fth WHERE quantity_norm <> 0 GROUP BY client_id)"""
    final = f"""SELECT substr(c.last_name, 1, 30) AS last_name, substr(c.first_name, 1, 30) AS first_name,
  CASE WHEN length({phone}) = 10 THEN {phone} END AS phone,
  CASE WHEN regexp_matches(c.primary_email, {_q('(?i)^[A-Z0-9._%+-]+@[A-Z0-9.-]+[.][A-Z]{2,4}$')}) THEN c.primary_email END AS primary_email,
  c.canines AS canine_count, {_mdy('lp.ft_canine')} AS last_purch_ft_canine, {_mdy('lp.hw_canine')} AS last_purch_hw_canine,
  c.felines AS feline_count, {_mdy('lp.ft_feline')} AS last_purch_ft_feline, {_mdy('lp.hw_feline')} AS last_purch_hw_feline,
  c.client_id, c.h_id, k.account_number, k.location_number, {_q(period)} AS time_period, k.clinic_name
FROM cli c JOIN good g ON g.client_id = c.client_id LEFT JOIN lp ON lp.client_id = c.client_id
JOIN clinics k ON k.h_id = c.h_id"""
    return with_ctes(ctes, final=final)



def consumer_file(ctx: RunContext) -> str:
    from ..plans.consumer import ADDRESS2_NOTE_WORDS

    base = consumer_report(ctx)
    i = base.index("SELECT '1DT' AS record_type")
    ctes, detail_sql = base[:i], base[i:]
    # raw (unformatted) metrics for the exclusions
    j = detail_sql.index("\nFROM cons_clients c")
    raw = "SELECT c.*, pm.*, sm.*" + detail_sql[j:]
    z = lambda c: f"coalesce({c}, 0) = 0"
    only_bg = " AND ".join([
        z("flt_rev_12"), "last_vacc_purch IS NULL", "last_pain_purch IS NULL", "last_dental_purch IS NULL",
        "last_surg_purch IS NULL", "last_other_purch IS NULL", z("combo_rev_12"), z("combo_rev_24"),
        z("comp_hg_rev_12"), z("comp_hg_rev_24"), z("hg_rev_12"), z("hg_rev_24"), z("comp_fl_rev_12"),
        z("comp_fl_rev_24"), z("fl_rev_12"), z("fl_rev_24"), z("ce_rev_12"),
        "(last_board_purch IS NOT NULL OR last_groom_purch IS NOT NULL)"])
    words = " OR ".join(f"contains(upper(address2), {_q(w)})" for w in ADDRESS2_NOTE_WORDS)
    dig = "length(regexp_replace(address2, '[^0-9]', '', 'g'))"
    card = "'[0-9]{16}|[0-9]{4}\\s[0-9]{4}\\s[0-9]{4}\\s[0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}'"
    phone = "'[0-9]{10}|[0-9]{3}\\s[0-9]{3}\\s[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}'"
    bad = (f"first_name = 'None Given' OR last_name = 'None Given' OR address1 = ' ' OR address1 = 'None Given' "
           f"OR contains(address1, '*') OR contains(address2, '*') OR {words} OR {dig} IN (10, 16) "
           f"OR regexp_matches(address2, {card}) OR regexp_matches(address2, {phone}) "
           f"OR (upper(first_name) = 'CASH' AND upper(last_name) IN ('CLIENT', 'CASH'))")
    kept_ids = f"SELECT client_id FROM ({raw}) WHERE NOT coalesce({only_bg}, false) AND NOT coalesce({bad}, false)"
    detail = detail_sql.replace("\nFROM cons_clients c", f"\nFROM (SELECT * FROM cons_clients WHERE client_id IN ({kept_ids})) c", 1)
    lo, hi = ctx.trailing(0)
    pc = f"""SELECT c.h_id,
      count(DISTINCT CASE WHEN c.vi_species_id = 3 AND p.type IN ('ft', 'f') THEN c.patient_id END) AS ft_canine_patients,
      count(DISTINCT CASE WHEN c.vi_species_id = 7 AND p.type IN ('ft', 'f') THEN c.patient_id END) AS ft_feline_patients,
      count(DISTINCT CASE WHEN c.vi_species_id = 3 AND p.type = 'h' THEN c.patient_id END) AS hw_canine_patients
    FROM (SELECT * FROM cons_lines WHERE is_fth AND invoice_date BETWEEN {d(lo)} AND {d(hi)}) p
    RIGHT JOIN cons_pat c ON c.patient_id = p.patient_id GROUP BY c.h_id"""
    head = f"""SELECT '1HD' AS record_type, '{ctx.as_of.strftime('%Y/%m/%d')}' AS first_name,
      CAST(n.n + 1 AS VARCHAR) AS last_name, k.account_number AS prefix, CAST(k.location_number AS VARCHAR) AS address1,
      substr(k.clinic_name, 1, 40) AS address2, k.state,
      CAST(pc.ft_canine_patients AS VARCHAR) AS last_hg_purch, CAST(pc.hw_canine_patients AS VARCHAR) AS last_ce_purch,
      CAST(pc.ft_feline_patients AS VARCHAR) AS last_fl_purch, k.h_id
    FROM clinics k JOIN (SELECT h_id, count(*) AS n FROM ({detail}) GROUP BY h_id) n ON n.h_id = k.h_id
    LEFT JOIN ({pc}) pc ON pc.h_id = k.h_id"""
    return ctes + f"SELECT * FROM ({detail}) UNION ALL BY NAME ({head})"


def ppr_t3(ctx: RunContext) -> str:
    periods_ = ", ".join(f"('{p[0]}')" for p in ppr_periods(ctx))
    rec = ("coalesce(CASE WHEN mk.report_name = 'Heartworm' THEN CASE WHEN s.species = 'Canine' THEN c.dose_rec_hw_dog ELSE c.dose_rec_hw_cat END "
           "ELSE CASE WHEN s.species = 'Canine' THEN c.dose_rec_ft_dog ELSE c.dose_rec_ft_cat END END, 0)")
    r = "g.rec"
    lbl = f"""CASE pos.p WHEN 1 THEN '0 Doses'
      WHEN 2 THEN CASE WHEN {r} = 0 THEN '0+ Doses' WHEN {r} = 1 THEN '1+ Doses' ELSE '1 Dose' END
      WHEN 3 THEN CASE WHEN {r} <= 1 THEN NULL WHEN {r} = 2 THEN '2+ Doses' WHEN {r} = 3 THEN '2 Doses'
                       ELSE '2-' || CAST({r} - 1 AS VARCHAR) || ' Doses' END
      ELSE CASE WHEN {r} <= 2 THEN NULL WHEN {r} = 3 THEN '3+ Doses' ELSE CAST({r} AS VARCHAR) || '+ Doses' END END"""
    dd, rr = "doses", "rec"
    label = f"""CASE WHEN {dd} = 0 THEN '0 Doses' WHEN {rr} = 0 AND {dd} >= 1 THEN '0+ Doses'
      WHEN {rr} = 1 AND {dd} >= 1 THEN '1+ Doses' WHEN {rr} > 1 AND {dd} = 1 THEN '1 Dose'
      WHEN {rr} = 3 AND {dd} = 2 THEN '2 Doses'
      WHEN {rr} > 3 AND {dd} BETWEEN 2 AND {rr} - 1 THEN '2-' || CAST({rr} - 1 AS VARCHAR) || ' Doses'
      ELSE CAST({rr} AS VARCHAR) || '+ Doses' END"""
    part = "PARTITION BY h_id, time_period, report_name, species"
    base = f"""SELECT d.h_id, d.time_period, d.report_name, d.species, d.doses, d.order_number,
    coalesce(a.patients, 0) AS patients,
    CASE WHEN sum(coalesce(a.patients, 0)) OVER (PARTITION BY d.h_id, d.time_period, d.report_name, d.species) = 0 THEN 0
         ELSE {sr('coalesce(a.patients, 0)', 'sum(coalesce(a.patients, 0)) OVER (PARTITION BY d.h_id, d.time_period, d.report_name, d.species)', 2)} END AS u
  FROM (SELECT * FROM (SELECT g.h_id, g.time_period, g.report_name, g.species, pos.p AS order_number, {lbl} AS doses
        FROM (SELECT c.h_id, tp.time_period, s.species, mk.report_name, {rec} AS rec
              FROM clinics c, (VALUES {periods_}) tp(time_period), (VALUES ('Canine'), ('Feline')) s(species),
                   (VALUES ('Flea/Tick'), ('Heartworm')) mk(report_name)) g, (VALUES (1), (2), (3), (4)) pos(p))
        WHERE doses IS NOT NULL) d
  LEFT JOIN (SELECT h_id, time_period, report_name, species, {label} AS doses, count(DISTINCT patient_id) AS patients
             FROM ppp GROUP BY 1, 2, 3, 4, 5) a
    ON a.h_id = d.h_id AND a.time_period = d.time_period AND a.report_name = d.report_name
   AND a.species = d.species AND a.doses = d.doses"""
    s_, mx = f"sum(u) OVER ({part})", f"max(u) OVER ({part})"
    final = f"""SELECT h_id, time_period, report_name, species, 'Total ' || substr(time_period, 7, 4) AS report_time_period,
  doses, CAST(patients AS BIGINT) AS total_patients,
  (CASE WHEN {s_} <> 100 AND u = {mx} THEN u + (100 - {s_}) ELSE u END) / 100.0 AS percent_patients,
  CAST(order_number AS BIGINT) AS order_number
FROM ({base})"""
    return with_ctes(*ppr_ctes(ctx), ppr_patient_period_cte(ctx), final=final)


def newly_inactive_file(ctx: RunContext) -> str:
    runs = [r for r in (_year_before(ctx), ctx) if run_flag(r) > 1]  # their years differ, so neither has rows of the other
    parts = []
    for r in runs:
        year, flag = r.end_date.year, run_flag(r)
        tail = f"CAST({year} AS BIGINT) AS report_year, CAST({flag} AS BIGINT) AS update_flag"
        body = newly_inactive(r)
        parts += [
            f"SELECT '1HD' AS record_type, '{r.as_of.strftime('%m/%d/%Y')}' AS creation_date, '{flag}' AS client_id, CAST({year} AS BIGINT) AS cc_year, {tail}",
            f"SELECT '2DT', CAST(location_number AS VARCHAR), CAST(client_id AS VARCHAR), CAST(NULL AS BIGINT), {tail} FROM ({body})",
            f"SELECT '3TR', CAST(count(*) + 2 AS VARCHAR), NULL, CAST(NULL AS BIGINT), {tail} FROM ({body}) HAVING count(*) > 0",
        ]
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


def _year_before(ctx: RunContext) -> RunContext:
    return ctx.with_(end_date=ctx.end_date.replace(year=ctx.end_date.year - 1),
                     as_of=ctx.as_of.replace(year=ctx.as_of.year - 1), update_flag=run_flag(ctx) - 1)


# ------------------------------------------------------------- accounts
def _status_sql() -> str:
    return """cstat AS (
  SELECT *, CASE WHEN h_id % 6 = 5 THEN 'Pending' ELSE 'HID Validated (R2)' END AS status,
    CASE WHEN h_id % 7 = 3 THEN 'No' ELSE 'Yes' END AS final_approval, h_id % 5 AS status_vi_portal FROM clinics
  WHERE h_id IN (SELECT DISTINCT h_id FROM patients))"""


def accounts(ctx: RunContext) -> str:
    return with_ctes(_status_sql(), final="""SELECT DISTINCT h_id AS hid, location_number, clinic_name, state AS ship_state,
  dose_rec_ft_dog, dose_rec_hw_dog, dose_rec_ft_cat, dose_rec_hw_cat, account_number
FROM cstat WHERE status = 'HID Validated (R2)' AND final_approval = 'Yes' AND status_vi_portal NOT IN (0)""")


def ppr_accounts(ctx: RunContext) -> str:
    per = ", ".join(f"('{p[0]}')" for p in ppr_periods(ctx))
    return with_ctes(_status_sql(), final=f"""SELECT h_id AS hid, location_number, clinic_name, dose_rec_ft_dog, dose_rec_hw_dog,
  dose_rec_ft_cat, dose_rec_hw_cat, account_number, pp.period_desc, {d(ctx.end_date)} AS end_date
FROM cstat, (VALUES {per}) pp(period_desc)
WHERE status = 'HID Validated (R2)' AND final_approval = 'Yes' AND status_vi_portal NOT IN (0, 11, 12, 16, 20)""")


def psr_meta(ctx: RunContext) -> str:
    acc = accounts(ctx)
    i = acc.index("SELECT DISTINCT h_id AS hid")
    return (ld_ctes_prefix(ctx) + ", " + _status_sql() + ", acc AS (" + acc[i:] + ")\n" +
            """SELECT r.run_id, r.h_id, a.account_number, a.location_number, r.end_date,
  strftime(r.end_date - INTERVAL 11 MONTH, '%b ''%y') || ' - ' || strftime(r.end_date, '%b ''%y') AS report_period,
  a.clinic_name, a.ship_state AS clinic_state
FROM (SELECT DISTINCT h_id, run_id, update_flag, make_date(CAST(update_flag + 1995 AS BIGINT), 12, 1) AS end_date FROM hist) r
JOIN acc a ON a.hid = r.h_id""")


def ld_ctes_prefix(ctx: RunContext) -> str:
    return "WITH " + ",\n".join(binding_ctes() + ld_ctes(ctx))


def wellness_services(ctx: RunContext) -> str:
    return with_ctes(final="""SELECT w.service_id, CASE WHEN p.service_kind = 'vaccine' THEN 'vaccine'
  WHEN p.service_kind = 'test' THEN 'heartworm test' ELSE 'spay/neuter' END AS reason
FROM wellness w JOIN products p ON p.service_id = w.service_id""")


def control_file(ctx: RunContext) -> str:
    mb = months_between(d(ctx.end_date), "p.dob")
    camp = f"invoice_date BETWEEN start_date AND {d(ctx.as_of - timedelta(days=1))}"
    cli = f"""ccli AS (
  SELECT c.client_id, c.h_id, coalesce({_strip('c.first_name', RE_NAME_JUNK)}, 'None Given') AS first_name,
    coalesce({_strip('c.last_name', RE_NAME_JUNK)}, 'None Given') AS last_name, c.title AS prefix,
    coalesce({_strip(_strip('c.address1', RE_ADDR_JUNK), RE_CNTRL)}, 'None Given') AS address1,
    {_strip(_strip('c.address2', RE_ADDR_JUNK), RE_CNTRL)} AS address2,
    {_strip('c.city', RE_CNTRL)} AS city, {_strip('c.state', RE_CNTRL)} AS state,
    trim({_strip("lpad(substr(CASE WHEN regexp_matches(c.postal_code, '[^0-9]') THEN nullif(regexp_replace(c.postal_code, '[^0-9]', '', 'g'), '') ELSE c.postal_code END, 1, 9), 30, ' ')", RE_CNTRL)}) AS postal_code,
    {_strip("substr(CASE WHEN regexp_matches(c.phone1, '[^0-9]') THEN nullif(regexp_replace(c.phone1, '[^0-9]', '', 'g'), '') ELSE c.phone1 END, 1, 10)", RE_CNTRL)} AS phone1,
    CASE WHEN regexp_matches(c.primary_email, {_q('(?i)^[A-Z0-9._%+-]+@[A-Z0-9.-]+[.][A-Z]{2,4}$')}) THEN c.primary_email END AS primary_email,
    h.dogs_over_5, h.dogs_over_4, h.canine_count, h.feline_count, h.first_visit
  FROM clients c
  JOIN (SELECT p.client_id, max(CASE WHEN {mb} > 60 AND p.vi_species_id = 3 THEN 1 ELSE 0 END) AS dogs_over_5,
          CAST(sum(CASE WHEN {mb} > 48 AND p.vi_species_id = 3 THEN 1 ELSE 0 END) AS BIGINT) AS dogs_over_4,
          count(DISTINCT CASE WHEN p.vi_species_id = 3 THEN p.patient_id END) AS canine_count,
          count(DISTINCT CASE WHEN p.vi_species_id = 7 THEN p.patient_id END) AS feline_count,
          min(a.first_active) AS first_visit
        FROM patients p JOIN activity a ON a.patient_id = p.patient_id
        WHERE p.is_active AND NOT p.is_deceased AND p.vi_species_id IN (3, 7) GROUP BY p.client_id) h ON h.client_id = c.client_id
  WHERE EXISTS (SELECT 1 FROM ctl WHERE ctl.h_id = c.h_id AND ctl.client_id = c.client_id))"""
    base = "SELECT * FROM ctl WHERE in_control AND type IS NOT NULL AND quantity_norm IS NOT NULL AND quantity_norm <> 0"
    subs, cols = [], []
    for tag, pred in CONTROL_TAG_SQL.items():
        subs.append(f"""LEFT JOIN (SELECT client_id, max(invoice_date) AS last_p,
      count(DISTINCT CASE WHEN {camp} THEN (l_orderkey, l_linenumber, l_partkey, l_suppkey) END) AS n,
      sum(CASE WHEN {camp} THEN cost END) AS rev, sum(CASE WHEN {camp} THEN quantity_norm END) AS doses,
      last(vi_species_id ORDER BY {LINE_ORDER}) AS sp
    FROM ({base}) WHERE {pred} GROUP BY client_id) p_{tag} ON p_{tag}.client_id = c.client_id""")
        cols += [f"{_mdy(f'p_{tag}.last_p')} AS last_{tag}_purch", f"coalesce(p_{tag}.n, 0) AS {tag}_purch_camp",
                 f"{_money(f'p_{tag}.rev')} AS {tag}_rev_camp", f"CAST(greatest(coalesce(p_{tag}.doses, 0), 0) AS BIGINT) AS {tag}_doses_camp",
                 f"p_{tag}.sp AS {tag}_last_pet_species"]
    for tag, pred in CONTROL_SERVICE_SQL.items():
        out = "unk" if tag == "other" else tag
        subs.append(f"""LEFT JOIN (SELECT client_id, count(CASE WHEN {camp} THEN 1 END) AS n, max(invoice_date) AS last,
      sum(CASE WHEN {camp} THEN cost ELSE 0 END) AS dollars FROM ctl WHERE {pred} GROUP BY client_id) s_{tag}
    ON s_{tag}.client_id = c.client_id""")
        cols += [f"coalesce(s_{tag}.n, 0) AS num_{out}_purch", f"{_mdy(f's_{tag}.last')} AS last_{out}_purch",
                 f"{_money(f's_{tag}.dollars')} AS dollar_{out}_purch"]
    for tag in ("comp_hg", "comp_fl"):
        cols.append(f"q_{tag}.prod AS {tag}_prod")
        subs.append(_last_product(base, tag, camp))
    w12, w24 = ctx.trailing(0), ctx.trailing(1)
    camp2 = f"invoice_date BETWEEN start_date AND {d(ctx.as_of - timedelta(days=1))}"
    subs.append(f"""LEFT JOIN (SELECT client_id,
      sum(CASE WHEN product LIKE 'Interceptor%' AND {_between('invoice_date', w12)} THEN quantity_norm ELSE 0 END) AS int_doses_12,
      sum(CASE WHEN product LIKE 'Interceptor%' AND {_between('invoice_date', w24)} THEN quantity_norm ELSE 0 END) AS int_doses_24,
      sum(CASE WHEN product LIKE 'Interceptor%' AND {camp2} THEN quantity_norm ELSE 0 END) AS int_doses_camp,
      sum(CASE WHEN family_name = 'Trifexis' AND {camp2} THEN quantity_norm ELSE 0 END) AS trif_doses,
      sum(CASE WHEN family_name = 'Revolution' AND {camp2} THEN quantity_norm ELSE 0 END) AS rev_doses,
      sum(CASE WHEN family_name = 'Advantage Multi' AND {camp2} THEN quantity_norm ELSE 0 END) AS adv_doses
    FROM ({base}) GROUP BY client_id) ox ON ox.client_id = c.client_id""")
    subs.append(f"""LEFT JOIN (SELECT client_id, count(DISTINCT CASE WHEN invoice_date BETWEEN {d(add_months(ctx.end_date, -12))} AND {d(ctx.end_date)} THEN invoice_date END) AS num_visits
    FROM ctl GROUP BY client_id) nv ON nv.client_id = c.client_id""")
    subs.append(f"LEFT JOIN ({control_nsaid_sql(ctx, per_client=True)}) pv ON pv.client_id = c.client_id")
    subs.append(f"LEFT JOIN ({control_dental_hygiene_sql(ctx, per_client=True)}) hy ON hy.client_id = c.client_id")
    cols += [f"CAST(greatest(coalesce(ox.{x}, 0), 0) AS BIGINT) AS {x}" for x in
             ("int_doses_12", "int_doses_24", "int_doses_camp", "trif_doses", "rev_doses", "adv_doses")]
    cols += ["CAST(coalesce(nv.num_visits, 0) AS BIGINT) AS num_visits"]
    cols += [f"CAST(coalesce(pv.{x}, 0) AS BIGINT) AS {x}" for x in ("num_prev_purch", "num_dogs")]
    cols += [f"CAST(coalesce(hy.{x}, 0) AS BIGINT) AS {x}" for x in ("num_oravet_purch", "num_dental_hyg_purch")]
    cols += [f"{_mdy('pv.last_prev_purch')} AS last_prev_purch", f"{_mdy('hy.last_oravet_purch')} AS last_oravet_purch",
             f"{_mdy('hy.last_dental_hyg_purch')} AS last_dental_hyg_purch"]
    cols += [f"{_money('pv.dollar_prev_purch')} AS dollar_prev_purch", f"{_money('hy.dollar_oravet_purch')} AS dollar_oravet_purch",
             f"{_money('hy.dollar_dental_hyg_purch')} AS dollar_dental_hyg_purch"]
    cols += [f"CAST(greatest(coalesce(pv.prev_pills, 0), 0) AS DOUBLE) AS prev_pills",
             f"CAST(greatest(coalesce(hy.doses_oravet_purch, 0), 0) AS DOUBLE) AS doses_oravet_purch",
             f"CAST(greatest(coalesce(hy.doses_dental_hyg_purch, 0), 0) AS DOUBLE) AS doses_dental_hyg_purch"]
    detail = f"""SELECT '1DT' AS record_type, c.client_id, c.h_id, c.first_name, c.last_name, c.prefix, c.address1, c.address2,
  c.city, c.state, c.postal_code, c.phone1, c.primary_email, c.dogs_over_5, c.dogs_over_4,
  c.canine_count, c.feline_count, {_mdy('c.first_visit')} AS first_visit, {_mdy('la.last_active')} AS last_active, {', '.join(cols)}
FROM ccli c LEFT JOIN (SELECT client_id, max(invoice_date) AS last_active FROM ctl GROUP BY client_id) la ON la.client_id = c.client_id
{chr(10).join(subs)}
WHERE c.state NOT IN ('AB','BC','MB','NB','NL','NT','NS','NU','ON','PE','QC','SK','YT','PR')
  AND NOT (c.first_name = 'None Given' OR c.last_name = 'None Given' OR c.address1 = 'None Given')
  AND c.first_visit IS NOT NULL"""
    head = f"""SELECT '1HD' AS record_type, '{ctx.as_of.strftime('%m/%d/%Y')}' AS first_name, CAST(n.n + 1 AS VARCHAR) AS last_name,
  k.account_number AS prefix, CAST(k.location_number AS VARCHAR) AS address1, substr(k.clinic_name, 1, 40) AS address2, k.h_id
FROM clinics k JOIN (SELECT h_id, count(*) AS n FROM ({detail}) GROUP BY h_id) n ON n.h_id = k.h_id"""
    return with_ctes(control_cte(ctx), cli, _matrix_cte(), final=f"SELECT * FROM ({detail}) UNION ALL BY NAME ({head})")


def clinic_xref_check(ctx: RunContext) -> str:
    acc = accounts(ctx)
    i = acc.index("SELECT DISTINCT h_id AS hid")
    return with_ctes(_status_sql(), f"acc AS ({acc[i:]})", final="""SELECT r.h_id, r.location_number,
  CASE WHEN EXISTS (SELECT 1 FROM acc WHERE acc.hid = r.h_id AND acc.location_number = r.location_number) THEN 1 ELSE -20004 END AS xref_status
FROM (SELECT h_id, location_number FROM clinics UNION ALL SELECT h_id, location_number + 1 FROM clinics) r""")


def consumer_clients_split(ctx: RunContext) -> str:
    base = consumer_clients(ctx)
    return base.replace("SELECT * FROM cons_clients", """SELECT c.* FROM cons_clients c
WHERE NOT EXISTS (SELECT 1 FROM clients s WHERE s.h_id % 5 = 0 AND s.client_id % 4 = 0 AND s.h_id = c.h_id)
   OR (c.h_id % 5 = 0 AND c.client_id % 4 = 0)""")


def last_dose_clients_split(ctx: RunContext) -> str:
    base = last_dose_clients(ctx)
    return base.replace("SELECT * FROM ld_cli", """SELECT c.* FROM ld_cli c
WHERE NOT EXISTS (SELECT 1 FROM clients s WHERE s.h_id % 5 = 0 AND s.client_id % 4 = 0 AND s.h_id = c.h_id)
   OR (c.h_id % 5 = 0 AND c.client_id % 4 = 0)""")


def legacy_wellness_services(ctx: RunContext) -> str:
    from ..operators.keywords import EXCLUDE_TERMS, INCLUDE_TERMS

    inc = f"(coalesce({_kw('handle', INCLUDE_TERMS)}, false) OR coalesce({_kw('descr', INCLUDE_TERMS)}, false))"
    exc = f"(coalesce({_kw('handle', EXCLUDE_TERMS)}, false) OR coalesce({_kw('descr', EXCLUDE_TERMS)}, false))"
    return with_ctes(final=f"""SELECT service_id FROM (
  SELECT p_partkey AS service_id, p_name AS handle, concat_ws(' ', p_type, p_brand) AS descr FROM part) l
WHERE NOT EXISTS (SELECT 1 FROM products x WHERE x.service_id = l.service_id
                  AND (x.service_kind IN ('nsaid', 'fth', 'test') OR x.product_info = 'Service - test'))
  AND {inc} AND NOT {exc}
UNION
SELECT service_id FROM wellness""")


def newly_inactive_merged(ctx: RunContext) -> str:
    flag = run_flag(ctx)
    prev_ctx = ctx.with_(end_date=ctx.end_date.replace(year=ctx.end_date.year - 1),
                         as_of=ctx.as_of.replace(year=ctx.as_of.year - 1), update_flag=flag - 1)
    both = " UNION ALL ".join(f"""SELECT h_id, client_id, CAST(location_number AS BIGINT) AS location_number, CAST(report_year AS BIGINT) AS report_year,
  CAST(update_flag AS BIGINT) AS update_flag, {d(c.as_of)} AS last_update, '{action}' AS action FROM ({newly_inactive(c)})"""
                              for c, action in ((prev_ctx, "keep"), (ctx, "insert")))
    return both  # the years differ, so no row of one is in the other
