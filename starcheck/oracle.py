"""Expected results in SQL, stated from the definitions: plain joins and unions, no rewrites.

Each oracle is a chain of the named steps it needs and a projection that pins every output type.
"""

from __future__ import annotations

from cohortry.vocabulary import CONDITION_FLAGS, GAP_MEASURES, RISK_TIERS, SERVICE_CODES
from starcheck.bind import AS_OF, STAR_SCHEMAS, YEAR, condition_map_rows
from starcheck.queries import CODE_RANGES


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def text_list(values) -> str:
    return ", ".join(text(v) for v in values)


def ratio(part: str, whole: str, digits: int) -> str:
    """Rounded once: integer arithmetic on both sides in millionths, halves away from zero."""
    above, below = (f"cast(cast({x} as decimal(38,6)) * 1000000 as hugeint)" for x in (part, whole))
    steps = f"(abs({above}) * {2 * 10**digits} + abs({below})) // nullif(2 * abs({below}), 0)"
    return f"cast(cast(sign({above}) * sign({below}) * ({steps}) as decimal(22,0)) * cast({10.0**-digits:.{digits}f} as decimal(7,{digits})) as decimal(28,{digits}))"


def ratio_even(part: str, whole: str, digits: int) -> str:
    """Rounded once, halves to the even digit; for values that are not negative."""
    above, below = (f"cast(cast({x} as decimal(38,6)) * 1000000 as hugeint)" for x in (part, whole))
    doubled, twice = f"({above} * {2 * 10**digits} + {below})", f"nullif(2 * {below}, 0)"
    steps = f"({doubled} // {twice} - if({doubled} % {twice} = 0 and ({doubled} // {twice}) % 2 = 1, 1, 0))"
    return f"cast(cast({steps} as decimal(22,0)) * cast({10.0**-digits:.{digits}f} as decimal(7,{digits})) as decimal(28,{digits}))"


def mean(column: str, digits: int) -> str:
    return ratio(f"sum({column})", f"count({column})", digits)


def row_key(*columns: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), '~null~')" for c in columns)
    return f"md5(concat_ws(chr(31), {parts}))"


def title(column: str) -> str:
    return f"upper(left({column}, 1)) || lower(substr({column}, 2))"


SHIPPED = "cast(l.l_shipdate as date)"
CLOSED = f"case when l.l_linestatus <> 'O' then {SHIPPED} + 90 end"
FLAGS = list(CONDITION_FLAGS.values())

# Step -> (steps it reads, SELECT).
STEPS: dict[str, tuple[list[str], str]] = {}


def step(name: str, reads: str, sql: str) -> None:
    STEPS[name] = (reads.split(), sql)


# Raw tables

step(
    "code_map",
    "",
    "select * from (values "
    + ", ".join(f"({text(c)}, {text(k)}, {text(k)}, {text(g)}, cast({w} as decimal(9,3)))" for c, k, g, w in condition_map_rows())
    + ") seed(code, category, label, grp, weight)",
)
step(
    "patients",
    "",
    """select cast(c.c_custkey as varchar) as id,
         date '1935-01-01' + cast(c.c_custkey * 7919 % 22000 as integer) as born,
         case when c.c_custkey % 17 = 0 then date '1999-06-30' + cast(c.c_custkey % 700 as integer) end as died,
         case when c.c_custkey % 50 = 0 then null when c.c_custkey % 2 = 0 then 'f' else 'M' end as gender,
         c.c_mktsegment as race,
         case when c.c_custkey % 4 = 0 then 'hispanic' else 'nonhispanic' end as ethnicity,
         n.n_name as state, 'city ' || c.c_nationkey as city, lpad(cast(c.c_custkey % 100000 as varchar), 5, '0') as zip,
         cast((cast(c.c_acctbal as decimal(18,2)) + 1000) * 60 as decimal(18,2)) as expenses,
         case when c.c_custkey % 13 <> 0
              then cast((cast(c.c_acctbal as decimal(18,2)) + 1000) * 40 as decimal(18,2)) end as coverage
       from customer c join nation n on n.n_nationkey = c.c_nationkey""",
)
step(
    "encounters",
    "",
    """select cast(o.o_orderkey as varchar) as id, cast(o.o_custkey as varchar) as patient,
         case when o.o_orderkey % 97 = 0 then null when o.o_orderkey % 101 = 0 then ''
              else cast((o.o_custkey * 13 + o.o_orderkey % 3) % (select count(*) from supplier) as varchar) end as provider,
         cast(o.o_orderkey % 5 as varchar) as payer,
         o.o_orderdate as start_ts, o.o_orderdate + to_days(cast(o.o_orderkey % 6 as integer)) as stop_ts,
         case o.o_orderpriority
              when '1-URGENT' then 'emergency' when '2-HIGH' then 'Inpatient'
              when '3-MEDIUM' then case o.o_orderkey % 4 when 0 then 'urgentcare' when 1 then 'outpatient'
                                        when 2 then 'ambulatory' else 'hospice' end
              when '4-NOT SPECIFIED' then 'wellness'
              else case when o.o_orderkey % 2 = 0 then 'office' else 'home' end end as class,
         case when o.o_orderkey % 3 <> 0 then cast(o.o_orderkey % 200 as varchar) end as reason,
         case when o.o_orderkey % 3 <> 0 then 'reason ' || (o.o_orderkey % 200) end as reason_text,
         o.o_orderstatus as code, o.o_orderpriority as description,
         cast(o.o_totalprice as decimal(18,2)) as total,
         cast(round(cast(o.o_totalprice as decimal(18,2)) * 0.5, 2) as decimal(18,2)) as base,
         case when o.o_orderkey % 19 <> 0
              then cast(round(cast(o.o_totalprice as decimal(18,2)) * 0.8, 2) as decimal(18,2)) end as covered
       from orders o""",
)
step(
    "conditions",
    "",
    f"""select cast(o.o_custkey as varchar) as patient,
          cast(case when l.l_partkey % 53 = 0 then -1 else l.l_orderkey end as varchar) as encounter,
          {SHIPPED} as start_date, {CLOSED} as stop_date,
          cast(l.l_partkey % 200 as varchar) as code, 'condition ' || (l.l_partkey % 200) as description
        from lineitem l join orders o on o.o_orderkey = l.l_orderkey where l.l_returnflag = 'R'""",
)
step(
    "procedures",
    "",
    f"""select cast(o.o_custkey as varchar) as patient, cast(l.l_orderkey as varchar) as encounter,
          {SHIPPED} as done_on,
          case l.l_partkey % 40 when 0 then '43396009' when 1 then '252779009' when 2 then '6615001'
               when 3 then '182836005' when 4 then '428191000124101' when 5 then '59408-5' when 6 then '410453006'
               else cast(l.l_partkey % 40 as varchar) end as code,
          'procedure ' || (l.l_partkey % 40) as description, cast(l.l_extendedprice as decimal(18,2)) as price
        from lineitem l join orders o on o.o_orderkey = l.l_orderkey where l.l_returnflag = 'N'""",
)
step(
    "medications",
    "",
    f"""select cast(o.o_custkey as varchar) as patient, cast(l.l_orderkey as varchar) as encounter,
          cast(l.l_suppkey % 5 as varchar) as payer, {SHIPPED} as start_date, {CLOSED} as stop_date,
          cast(l.l_partkey % 300 as varchar) as code, 'drug ' || (l.l_partkey % 300) as description,
          cast(l.l_extendedprice as decimal(18,2)) as total,
          cast(round(cast(l.l_extendedprice as decimal(18,2)) * 0.5, 2) as decimal(18,2)) as base,
          case when l.l_linenumber <> 3
               then cast(round(cast(l.l_extendedprice as decimal(18,2)) * 0.7, 2) as decimal(18,2)) end as covered,
          case when l.l_linenumber <> 7 then cast(l.l_quantity as bigint) end as dispensed,
          case when l.l_partkey % 7 <> 0 then cast(l.l_partkey % 200 as varchar) end as reason,
          case when l.l_partkey % 7 <> 0 then 'reason ' || (l.l_partkey % 200) end as reason_text
        from lineitem l join orders o on o.o_orderkey = l.l_orderkey where l.l_returnflag = 'A'""",
)
step("supply", "", "select cast(s_suppkey as varchar) as id from supplier")

# Staging

step(
    "members",
    "patients",
    f"""select id as member_id, born as date_of_birth, died as death_date, {YEAR} - year(born) as age_at_year_end,
          case upper(gender) when 'M' then 'M' when 'F' then 'F' else 'U' end as sex,
          {title("race")} as race, {title("ethnicity")} as ethnicity, state, city, zip as zip_code,
          coalesce(expenses, 0) as total_healthcare_expenses, coalesce(coverage, 0) as total_healthcare_coverage,
          coalesce(expenses, 0) - coalesce(coverage, 0) as total_out_of_pocket,
          died is not null as is_deceased, {YEAR} as measurement_year
        from patients""",
)
step(
    "visits",
    "encounters",
    """select id as encounter_id, patient as member_id, provider as provider_id, payer as payer_id,
         start_ts as service_start_ts, stop_ts as service_end_ts,
         cast(start_ts as date) as service_date, cast(stop_ts as date) as service_end_date,
         lower(class) as encounter_class,
         case when lower(class) in ('inpatient', 'emergency') then lower(class)
              when lower(class) in ('office', 'wellness', 'home') then 'carrier' else 'outpatient' end as claim_type,
         reason as reason_snomed_code, reason_text as reason_description, code as encounter_snomed_code,
         description as encounter_description, coalesce(base, 0) as base_encounter_cost,
         coalesce(total, 0) as paid_amount, coalesce(covered, 0) as payer_coverage,
         coalesce(total, 0) - coalesce(covered, 0) as member_paid_amount, year(start_ts) as service_year
       from encounters""",
)
step(
    "diagnoses",
    "conditions",
    f"""select {row_key("patient", "code", "start_date")} as condition_id, patient as member_id,
          encounter as encounter_id, start_date as onset_date, stop_date as resolution_date, code as snomed_code,
          description as condition_description, stop_date is null as is_active, year(start_date) as onset_year
        from conditions""",
)
step(
    "services",
    "procedures",
    f"""select {row_key("patient", "code", "done_on", "encounter")} as procedure_id, patient as member_id,
          encounter as encounter_id, done_on as procedure_date, done_on as procedure_end_date, code as snomed_code,
          description as procedure_description, coalesce(price, 0) as base_cost, year(done_on) as procedure_year
        from procedures""",
)
step(
    "drugs",
    "medications",
    f"""select {row_key("patient", "code", "start_date", "encounter", "stop_date", "total")} as rx_id,
          patient as member_id, encounter as encounter_id, payer as payer_id, start_date, stop_date,
          code as rxnorm_code, description as drug_description, coalesce(base, 0) as base_cost,
          coalesce(covered, 0) as payer_coverage, coalesce(total, 0) as total_drug_cost,
          coalesce(dispensed, 1) as dispenses, reason as reason_snomed_code, reason_text as reason_description,
          stop_date is null as is_active
        from medications""",
)

# Intermediate

step(
    "dx_lines",
    "diagnoses visits",
    """select d.condition_id as claims_line_id, v.encounter_id as claim_id, d.member_id, v.service_date,
         v.service_end_date, v.provider_id as provider_npi, v.claim_type, d.snomed_code as dx_code,
         d.condition_description as dx_description, cast(null as varchar) as procedure_code,
         cast(0 as decimal(18,2)) as paid_amount, v.service_year, v.encounter_class
       from visits v join diagnoses d using (encounter_id)""",
)
step(
    "service_lines",
    "services visits",
    """select s.procedure_id as claims_line_id, v.encounter_id as claim_id, s.member_id, v.service_date,
         v.service_end_date, v.provider_id as provider_npi, v.claim_type, cast(null as varchar) as dx_code,
         cast(null as varchar) as dx_description, s.snomed_code as procedure_code,
         cast(0 as decimal(18,2)) as paid_amount, v.service_year, v.encounter_class
       from visits v join services s using (encounter_id)""",
)
step(
    "spine",
    "visits dx_lines service_lines",
    """select encounter_id as claims_line_id, encounter_id as claim_id, member_id, service_date, service_end_date,
         provider_id as provider_npi, claim_type, reason_snomed_code as dx_code, reason_description as dx_description,
         cast(null as varchar) as procedure_code, paid_amount, service_year, encounter_class from visits
       union all by name select * from dx_lines
       union all by name select * from service_lines""",
)
step(
    "mapped",
    "diagnoses code_map",
    """select d.condition_id, d.member_id, d.encounter_id, d.onset_date as service_date, d.onset_year as service_year,
         d.snomed_code as dx_code, d.condition_description, d.is_active, m.category as condition_category,
         m.label as condition_label, m.grp as hcc_category, m.weight as hcc_weight
       from diagnoses d left join code_map m on m.code = d.snomed_code""",
)
step(
    "by_category",
    "mapped",
    """select member_id, condition_category, count(distinct dx_code) as distinct_codes, count(*) as total_occurrences,
         min(service_date) as first_dx_date, max(service_date) as last_dx_date,
         cast(bool_or(is_active) as bigint) as currently_active, sum(hcc_weight) as raw_hcc_contribution
       from mapped where condition_category is not null group by all""",
)
step(
    "flagged",
    "mapped",
    "select member_id, "
    + ", ".join(
        f"cast(bool_or(condition_category = {text(c)}) as bigint) as {flag}" for c, flag in CONDITION_FLAGS.items()
    )
    + """, count(distinct condition_category) as confirmed_condition_count,
         least(coalesce(sum(hcc_weight), 0), 5) as hcc_risk_score, coalesce(sum(hcc_weight), 0) as hcc_risk_score_raw
       from mapped where condition_category is not null group by member_id""",
)
step(
    "usage",
    "visits",
    """select member_id, count(distinct encounter_id) as total_encounters,
         count(*) filter (where claim_type = 'inpatient') as ip_admit_count,
         count(*) filter (where claim_type = 'emergency') as er_visit_count,
         count(*) filter (where claim_type = 'carrier') as office_visit_count,
         sum(paid_amount) as total_encounter_cost, max(service_date) as last_encounter_date
       from visits group by member_id""",
)
step(
    "drug_use",
    "drugs",
    """select member_id, count(distinct rxnorm_code) as distinct_drugs,
         count(*) filter (where is_active) as active_medications, sum(total_drug_cost) as total_rx_cost
       from drugs group by member_id""",
)

# Marts

_MONTHS = f"""(year(coalesce(m.death_date, date '{AS_OF}')) - 1950) * 12
   + month(coalesce(m.death_date, date '{AS_OF}')) - 1"""
_PMPM = f"""{ratio("m.total_healthcare_expenses", f"greatest({_MONTHS}, 1)", 2)} as cost_pmpm_lifetime,
   {ratio("m.total_healthcare_expenses", "(greatest(m.age_at_year_end, 1) * 12)", 2)} as cost_pmpm"""

step("pmpm", "members", f"select m.member_id, {_PMPM} from members m")
step(
    "unranked",
    "members flagged usage drug_use",
    f"""select m.member_id, m.measurement_year, m.age_at_year_end, m.sex, m.race, m.ethnicity, m.state, m.city,
          m.is_deceased, {", ".join(f"coalesce(f.{flag}, 0) as {flag}" for flag in FLAGS)},
          coalesce(f.confirmed_condition_count, 0) as condition_count,
          cast(coalesce(f.hcc_risk_score, 0) as decimal(9,3)) as hcc_risk_score,
          coalesce(u.total_encounters, 0) as total_encounters, coalesce(u.ip_admit_count, 0) as ip_admit_count,
          coalesce(u.er_visit_count, 0) as er_visit_count, coalesce(u.office_visit_count, 0) as office_visit_count,
          coalesce(r.distinct_drugs, 0) as distinct_drugs, coalesce(r.active_medications, 0) as active_medications,
          coalesce(u.total_encounter_cost, 0) as total_encounter_cost, coalesce(r.total_rx_cost, 0) as total_rx_cost,
          m.total_healthcare_expenses, {_PMPM}
        from members m left join flagged f using (member_id) left join usage u using (member_id)
          left join drug_use r using (member_id)""",
)
step(
    "profile",
    "unranked",
    """select *, case
         when cc_cancer = 1 or hcc_risk_score >= 1.5 or er_visit_count >= 5 or ip_admit_count >= 3 then 'high'
         when cost_pmpm >= 1000 or condition_count >= 4 or hcc_risk_score >= 0.8 then 'moderate'
         when condition_count >= 2 and greatest(ip_admit_count * 2, er_visit_count) >= 2 then 'rising_cost'
         else 'low' end as risk_tier from unranked""",
)


def _service_step(name: str, extra: str) -> None:
    measures = []
    for service, (closing, dated) in SERVICE_CODES.items():
        measures.append(f"coalesce(max(cast(s.snomed_code in ({text_list(closing)}) as bigint)), 0) as had_{service}")
        measures.append(f"max(s.procedure_date) filter (where s.snomed_code in ({text_list(dated)})) as last_{service}_date")
    step(
        name,
        "profile services",
        f"""select p.member_id, p.cc_diabetes = 1 as is_diabetic, p.distinct_drugs >= 5 as is_polypharmacy,
              {", ".join(measures)}
            from profile p left join services s on s.member_id = p.member_id{extra}
            where p.cc_diabetes = 1 or p.distinct_drugs >= 5 group by all""",
    )


_service_step("gap_services", "")
_service_step("gap_services_in_year", f" and s.procedure_year = {YEAR}")
step(
    "stays",
    "visits",
    """select member_id, service_date as admitted, service_date - lag(service_end_date)
         over (partition by member_id order by service_date, encounter_id) as days_home
       from visits where claim_type = 'inpatient'""",
)
step(
    "returns",
    "stays",
    """select member_id, max(cast(coalesce(days_home between 1 and 30, false) as bigint)) as had_readmission,
         max(admitted) filter (where days_home between 1 and 30) as readmission_date
       from stays group by member_id""",
)


def _gap_step(name: str, services: str, readmission_join: str) -> None:
    def branch(gap_type: str, open_expr: str, date_expr: str, source: str) -> str:
        label, definition = GAP_MEASURES[gap_type]
        return f"""select {row_key("p.member_id", text(gap_type), "p.measurement_year")} as gap_id, p.member_id,
              p.measurement_year, {text(gap_type)} as gap_type, {text(label)} as gap_label, {open_expr} as gap_open,
              {date_expr} as last_service_date, {text(definition)} as gap_definition from profile p {source}"""

    served = f"join {services} g on g.member_id = p.member_id"
    step(
        name,
        f"profile {services} returns",
        " union all ".join(
            [
                branch("diabetes_a1c", "1 - g.had_a1c", "g.last_a1c_date", f"{served} where g.is_diabetic"),
                branch("diabetes_eye_exam", "1 - g.had_eye_exam", "g.last_eye_exam_date", f"{served} where g.is_diabetic"),
                branch("high_risk_med_review", "1 - g.had_med_review", "g.last_med_review_date", f"{served} where g.is_polypharmacy"),
                branch("readmission_30d", "coalesce(r.had_readmission, 0)", "r.readmission_date", f"{readmission_join} returns r on r.member_id = p.member_id"),
            ]
        ),
    )


_gap_step("gaps", "gap_services", "left join")
_gap_step("gaps_in_year", "gap_services_in_year", "join")

step(
    "tiers",
    "profile",
    f"""select risk_tier, measurement_year, count(distinct member_id) as member_count,
          {mean("cost_pmpm", 2)} as avg_cost_pmpm, sum(total_healthcare_expenses) as total_cost_ytd,
          {ratio("sum(total_encounter_cost) * 0.4", "count(*)", 2)} as avg_inpatient_spend,
          {ratio("sum(total_encounter_cost) * 0.3", "count(*)", 2)} as avg_outpatient_spend,
          {ratio("sum(total_encounter_cost) * 0.3", "count(*)", 2)} as avg_professional_spend,
          {mean("total_rx_cost", 2)} as avg_rx_spend,
          {ratio("sum(ip_admit_count) * 1000", "count(distinct member_id)", 1)} as ip_admits_per_1000,
          {ratio("sum(er_visit_count) * 1000", "count(distinct member_id)", 1)} as er_visits_per_1000,
          {ratio("sum(distinct_drugs) * 1000", "count(distinct member_id)", 1)} as rx_fills_per_1000,
          {mean("hcc_risk_score", 3)} as avg_hcc_risk_score, {mean("condition_count", 1)} as avg_condition_count,
          {mean("distinct_drugs", 1)} as avg_distinct_drugs, {mean("age_at_year_end", 1)} as avg_age,
          cast(count(*) filter (where sex = 'F') as double) * 100.0 / cast(count(*) as double) as pct_female
        from profile group by risk_tier, measurement_year""",
)
step(
    "cost",
    "tiers",
    f"""select t.*, {ratio("t.member_count * 100", "y.members", 1)} as pct_of_population,
          {ratio("t.total_cost_ytd * 100", "y.spend", 1)} as pct_of_total_cost
        from tiers t join (select measurement_year, sum(member_count) as members, sum(total_cost_ytd) as spend
                           from tiers group by measurement_year) y using (measurement_year)""",
)
step("billable", "spine", "select * from spine where length(provider_npi) > 0")
step(
    "attributed",
    "billable",
    """select member_id, provider_npi, claim_count from (
         select member_id, provider_npi, claim_count,
           rank() over (partition by member_id order by claim_count desc, provider_npi) as place
         from (select member_id, provider_npi, count(distinct claim_id) as claim_count from billable group by all))
       where place = 1""",
)
step(
    "spend",
    "billable",
    """select provider_npi, sum(paid_amount) as total_spend, count(distinct member_id) as attributed_member_count,
         count(distinct member_id) filter (where claim_type = 'inpatient') as members_with_ip
       from billable group by provider_npi""",
)
step(
    "common_condition",
    "billable mapped",
    """select provider_npi, condition_category, pair_count from (
         select b.provider_npi, m.condition_category, count(*) as pair_count,
           row_number() over (partition by b.provider_npi order by count(*) desc, m.condition_category) as place
         from billable b join mapped m on m.encounter_id = b.claim_id
         where m.condition_category is not null group by b.provider_npi, m.condition_category)
       where place = 1""",
)
step(
    "closure",
    "gaps",
    """select member_id, cast(cast(count(*) filter (where gap_open = 0) as double) / count(*) as decimal(18,9))
         as gap_closure_rate from gaps group by member_id""",
)
step(
    "assembled",
    "attributed profile spend closure common_condition",
    f"""select a.provider_npi, any_value(s.attributed_member_count) as attributed_member_count,
          {mean("p.hcc_risk_score", 3)} as avg_hcc_score, {mean("p.cost_pmpm", 2)} as avg_cost_pmpm,
          any_value(s.total_spend) as total_attributed_spend,
          {ratio("sum(p.cost_pmpm)", "cast(sum(p.hcc_risk_score) as double)", 2)} as cost_per_hcc_unit,
          {ratio("sum(c.gap_closure_rate) * 100", "count(c.gap_closure_rate)", 1)} as gap_closure_rate_pct,
          {mean("p.condition_count", 1)} as avg_condition_count, any_value(t.condition_category) as top_condition
        from attributed a join profile p on p.member_id = a.member_id join spend s on s.provider_npi = a.provider_npi
          left join closure c on c.member_id = a.member_id
          left join common_condition t on t.provider_npi = a.provider_npi
        group by a.provider_npi""",
)
step(
    "quadrants",
    "assembled",
    """select a.*, m.median_cost, m.median_hcc,
         case when avg_cost_pmpm <= median_cost and avg_hcc_score >= median_hcc then 'High Value'
              when avg_cost_pmpm > median_cost and avg_hcc_score < median_hcc then 'Low Value'
              when avg_cost_pmpm > median_cost and avg_hcc_score >= median_hcc then 'Complex High Cost'
              else 'Complex Managed' end as efficiency_quadrant
       from assembled a, (select cast(quantile_cont(cast(avg_cost_pmpm as double), 0.5) as decimal(28,6)) as median_cost,
                            cast(quantile_cont(cast(avg_hcc_score as double), 0.5) as decimal(28,6)) as median_hcc
                          from assembled) m""",
)
step("efficiency", "quadrants", "select * from quadrants where attributed_member_count >= 5")

# Projections

ORACLES: dict[str, str] = {}


def _needed(name: str, seen: dict[str, None]) -> dict[str, None]:
    for other in STEPS[name][0]:
        _needed(other, seen)
    seen[name] = None
    return seen


def chain(reads: str, final: str) -> str:
    seen: dict[str, None] = {}
    for name in reads.split():
        _needed(name, seen)
    steps = ", ".join(f"{name} as ({STEPS[name][1]})" for name in seen)
    return f"with {steps} {final}" if steps else final


KINDS = {"i": "bigint", "d": "double", "t": "varchar", "b": "boolean"}


def project(columns: str) -> str:
    """``i:a d:b`` -> typed select list."""
    typed = [item.split(":") for item in columns.split()]
    return ", ".join(f"cast({name} as {KINDS[kind]}) as {name}" for kind, name in typed)


def expect(query: str, reads: str, columns: str, tail: str | None = None) -> None:
    source = tail if tail is not None else f"from {reads.split()[0]}"
    ORACLES[query] = chain(reads, f"select {project(columns)} {source}")


expect(
    "ingest_roundtrip",
    "conditions",
    "t:PATIENT t:ENCOUNTER t:START t:STOP t:CODE t:DESCRIPTION t:NOTE t:misfits",
    """from (select patient as "PATIENT", encounter as "ENCOUNTER", start_date as "START", stop_date as "STOP",
         code as "CODE", 'n' || code as "NOTE", description || chr(10) || 'says "' || code || '"' as "DESCRIPTION",
         cast(null as varchar) as misfits from conditions
       union all
       select patient, encounter, start_date, stop_date, code, 'n' || code, description, '(surplus fields)' from conditions where code like '%7')""",
)
expect(
    "condition_map_scan",
    "code_map diagnoses",
    "t:snomed_code t:condition_category t:condition_label t:hcc_category d:hcc_weight i:diagnoses",
    """from (select m.code as snomed_code, m.category as condition_category, m.label as condition_label,
         m.grp as hcc_category, m.weight as hcc_weight,
         (select count(*) from diagnoses d where d.snomed_code = m.code) as diagnoses from code_map m)""",
)
expect(
    "stg_members",
    "members",
    "t:member_id t:date_of_birth t:death_date i:age_at_year_end t:sex t:race t:ethnicity t:state t:city t:zip_code"
    " d:total_healthcare_expenses d:total_healthcare_coverage d:total_out_of_pocket b:is_deceased i:measurement_year",
)
expect(
    "stg_encounters",
    "visits",
    "t:encounter_id t:member_id t:provider_id t:payer_id t:service_start_ts t:service_end_ts t:service_date"
    " t:service_end_date t:encounter_class t:claim_type t:reason_snomed_code t:reason_description"
    " t:encounter_snomed_code t:encounter_description d:base_encounter_cost d:paid_amount d:payer_coverage"
    " d:member_paid_amount i:service_year",
)
expect(
    "stg_conditions",
    "diagnoses",
    "t:condition_id t:member_id t:encounter_id t:onset_date t:resolution_date t:snomed_code t:condition_description"
    " b:is_active i:onset_year",
)
expect(
    "stg_procedures",
    "services",
    "t:procedure_id t:member_id t:encounter_id t:procedure_date t:procedure_end_date t:snomed_code"
    " t:procedure_description d:base_cost i:procedure_year",
)
expect(
    "stg_medications",
    "drugs",
    "t:rx_id t:member_id t:encounter_id t:payer_id t:start_date t:stop_date t:rxnorm_code t:drug_description"
    " d:base_cost d:payer_coverage d:total_drug_cost i:dispenses t:reason_snomed_code t:reason_description b:is_active",
)
expect(
    "surrogate_keys",
    "diagnoses services drugs",
    "t:source t:member_id t:row_key",
    """from (select 'condition' as source, member_id, condition_id as row_key from diagnoses
         union all select 'procedure', member_id, procedure_id from services
         union all select 'medication', member_id, rx_id from drugs)""",
)
_LINE = (
    "t:claims_line_id t:claim_id t:member_id t:service_date t:service_end_date t:provider_npi t:claim_type t:dx_code"
    " t:dx_description t:procedure_code d:paid_amount i:service_year t:encounter_class"
)
expect("claims_dx_lines", "dx_lines", _LINE)
expect("claims_procedure_lines", "service_lines", _LINE)
expect("int_claims_unioned", "spine", _LINE)
expect(
    "int_dx_code_flags",
    "mapped",
    "t:condition_id t:member_id t:encounter_id t:service_date i:service_year t:dx_code t:condition_description"
    " b:is_active t:condition_category t:condition_label t:hcc_category d:hcc_weight",
)
expect(
    "int_member_condition_summary",
    "by_category",
    "t:member_id t:condition_category i:distinct_codes i:total_occurrences t:first_dx_date t:last_dx_date"
    " i:currently_active d:raw_hcc_contribution",
)
_FLAG_COLUMNS = " ".join(f"i:{flag}" for flag in FLAGS)
expect(
    "int_member_chronic_flags",
    "flagged",
    f"t:member_id {_FLAG_COLUMNS} i:confirmed_condition_count d:hcc_risk_score d:hcc_risk_score_raw",
)
expect(
    "encounter_util",
    "usage",
    "t:member_id i:total_encounters i:ip_admit_count i:er_visit_count i:office_visit_count d:total_encounter_cost"
    " t:last_encounter_date",
)
_DRUG_USE = "t:member_id i:distinct_drugs i:active_medications d:total_rx_cost"
expect("med_summary", "drug_use", _DRUG_USE)
expect("member_pmpm", "pmpm", "t:member_id d:cost_pmpm_lifetime d:cost_pmpm")
expect(
    "risk_tier_assignment",
    "profile",
    "t:member_id d:hcc_risk_score i:ip_admit_count i:er_visit_count i:cc_cancer i:condition_count d:cost_pmpm t:risk_tier",
)
expect(
    "mart_member_risk_profile",
    "profile",
    "t:member_id i:measurement_year i:age_at_year_end t:sex t:race t:ethnicity t:state t:city b:is_deceased"
    f" {_FLAG_COLUMNS} i:condition_count d:hcc_risk_score i:total_encounters i:ip_admit_count i:er_visit_count"
    " i:office_visit_count i:distinct_drugs i:active_medications d:total_encounter_cost d:total_rx_cost"
    " d:total_healthcare_expenses d:cost_pmpm_lifetime d:cost_pmpm t:risk_tier",
)
expect(
    "mart_cost_utilization",
    "cost",
    "t:risk_tier i:measurement_year i:member_count d:avg_cost_pmpm d:total_cost_ytd d:avg_inpatient_spend"
    " d:avg_outpatient_spend d:avg_professional_spend d:avg_rx_spend d:ip_admits_per_1000 d:er_visits_per_1000"
    " d:rx_fills_per_1000 d:avg_hcc_risk_score d:avg_condition_count d:avg_distinct_drugs d:avg_age d:pct_female"
    " d:pct_of_population d:pct_of_total_cost",
)
expect("polypharmacy_members", "drug_use", _DRUG_USE, "from drug_use where distinct_drugs >= 5")
expect(
    "care_gap_services",
    "gap_services",
    "t:member_id b:is_diabetic b:is_polypharmacy i:had_a1c i:had_eye_exam i:had_med_review t:last_a1c_date"
    " t:last_eye_exam_date t:last_med_review_date",
)
expect("readmission_flags", "returns", "t:member_id i:had_readmission t:readmission_date")
_GAP = (
    "t:gap_id t:member_id i:measurement_year t:gap_type t:gap_label i:gap_open t:last_service_date t:gap_definition"
)
expect("mart_care_gaps", "gaps", _GAP)
expect("mart_care_gaps_within_year", "gaps_in_year", _GAP)
expect("primary_provider", "attributed", "t:member_id t:provider_npi i:claim_count")
expect("provider_spend", "spend", "t:provider_npi d:total_spend i:attributed_member_count i:members_with_ip")
expect("provider_top_condition", "common_condition", "t:provider_npi t:condition_category i:pair_count")
expect("gap_closure_by_member", "closure", "t:member_id d:gap_closure_rate")
_ASSEMBLED = (
    "t:provider_npi i:attributed_member_count d:avg_hcc_score d:avg_cost_pmpm d:total_attributed_spend"
    " d:cost_per_hcc_unit d:gap_closure_rate_pct d:avg_condition_count t:top_condition"
)
_QUADRANT = f"{_ASSEMBLED} d:median_cost d:median_hcc t:efficiency_quadrant"
expect("provider_assembled", "assembled", _ASSEMBLED)
expect("provider_quadrants", "quadrants", _QUADRANT)
expect("mart_provider_efficiency", "efficiency", _QUADRANT)
expect("mart_provider_efficiency_min42", "quadrants", _QUADRANT, "from quadrants where attributed_member_count >= 42")

# Codes

expect(
    "code_range_filter",
    "diagnoses",
    "t:condition_id t:member_id t:snomed_code b:within_exact_range",
    """from (select condition_id, member_id, snomed_code, snomed_code between '11' and '13' as within_exact_range
         from diagnoses where snomed_code between '11' and '13' or snomed_code like '13%')""",
)
expect(
    "code_set_filter",
    "services",
    "t:procedure_id t:member_id t:snomed_code t:procedure_date",
    "from services where snomed_code in ('252779009', '6615001', '410453006', '410451008')",
)
expect(
    "condition_flag_agg",
    "mapped",
    "t:member_id i:has_diabetes i:has_chf",
    """from (select member_id, max(if(condition_category = 'diabetes_t2', 1, 0)) as has_diabetes,
         max(if(condition_category = 'chf', 1, 0)) as has_chf from mapped group by member_id)""",
)
expect(
    "code_range_join",
    "diagnoses",
    "t:condition_id t:member_id t:snomed_code t:low_code t:high_code t:range_label",
    "from diagnoses join (values "
    + ", ".join(f"({text_list(row)})" for row in CODE_RANGES)
    + ") r(low_code, high_code, range_label) on snomed_code >= low_code and snomed_code <= high_code",
)
expect(
    "wide_codes_to_long",
    "",
    "i:claim_id t:code_column t:code",
    """from (select l_orderkey as claim_id, 'code_' || l_linenumber as code_column,
         case when l_partkey % 11 = 0 then '' else cast(l_partkey % 200 as varchar) end as code
         from lineitem) where code <> ''""",
)

# Quality

_KEYS = {
    "patients": ("patients", "id"),
    "encounters": ("encounters", "id"),
    "providers": ("supply", "id"),
    "stg_members": ("members", "member_id"),
    "stg_encounters": ("visits", "encounter_id"),
    "stg_conditions": ("diagnoses", "condition_id"),
    "stg_procedures": ("services", "procedure_id"),
    "stg_medications": ("drugs", "rx_id"),
    "int_claims_unioned": ("spine", "claims_line_id"),
    "int_member_chronic_flags": ("flagged", "member_id"),
    "mart_member_risk_profile": ("profile", "member_id"),
    "mart_care_gaps": ("gaps", "gap_id"),
    "mart_provider_efficiency": ("efficiency", "provider_npi"),
}
_DATASET_STEP = {
    **{table: name for table, (name, _) in _KEYS.items()},
    "conditions": "conditions",
    "procedures": "procedures",
    "medications": "medications",
    "int_dx_code_flags": "mapped",
    "mart_cost_utilization": "cost",
}
_RESULT = "t:check_type t:table_name t:column_name i:failing t:check_result"


def _verdicts(kind: str, rows: list[tuple[str, str, str]]) -> None:
    """``rows``: dataset, column, scalar SQL of the failing count."""
    reads = " ".join(dict.fromkeys(_DATASET_STEP[table] for table, _, _ in rows))
    union = " union all ".join(
        f"select {text(table)} as table_name, {text(column)} as column_name, ({failing}) as failing"
        for table, column, failing in rows
    )
    expect(
        f"dq_{kind}",
        reads,
        _RESULT,
        f"from (select {text(kind)} as check_type, *, if(failing > 0, 'fail', 'pass') as check_result from ({union}))",
    )


_verdicts(
    "unique",
    [
        (
            table,
            "Id" if column == "id" else column,
            f"select count(*) from (select 1 from {name} where {column} is not null group by {column} having count(*) > 1)",
        )
        for table, (name, column) in _KEYS.items()
    ],
)
_REQUIRED = {
    "patients": {"Id": "id", "BIRTHDATE": "born", "GENDER": "gender"},
    "encounters": {"Id": "id", "PATIENT": "patient", "START": "start_ts"},
    "conditions": {"PATIENT": "patient", "CODE": "code"},
    "procedures": {"PATIENT": "patient"},
    "medications": {"PATIENT": "patient"},
    "providers": {"Id": "id"},
    "stg_members": ["member_id", "measurement_year"],
    "stg_encounters": ["encounter_id", "member_id", "claim_type"],
    "stg_conditions": ["condition_id", "member_id", "snomed_code"],
    "stg_procedures": ["procedure_id", "member_id"],
    "stg_medications": ["rx_id", "member_id"],
    "int_claims_unioned": ["claims_line_id", "member_id"],
    "int_dx_code_flags": ["member_id", "dx_code"],
    "int_member_chronic_flags": ["member_id"],
    "mart_member_risk_profile": ["member_id", "measurement_year", "risk_tier", "hcc_risk_score"],
    "mart_care_gaps": ["gap_id", "member_id", "gap_type", "gap_open"],
    "mart_cost_utilization": ["risk_tier", "measurement_year"],
    "mart_provider_efficiency": ["provider_npi", "efficiency_quadrant"],
}
_verdicts(
    "not_null",
    [
        (table, column, f"select count(*) - count({columns[column] if isinstance(columns, dict) else column}) from {_DATASET_STEP[table]}")
        for table, columns in _REQUIRED.items()
        for column in columns
    ],
)
_CLAIM_TYPES = ["carrier", "emergency", "inpatient", "outpatient"]
_verdicts(
    "accepted_values",
    [
        (table, column, f"select count(*) from {_DATASET_STEP[table]} where {column} not in ({text_list(values)})")
        for table, column, values in [
            ("stg_members", "sex", ["F", "M", "U"]),
            ("stg_encounters", "claim_type", _CLAIM_TYPES),
            ("int_claims_unioned", "claim_type", _CLAIM_TYPES),
            ("mart_member_risk_profile", "risk_tier", RISK_TIERS),
            ("mart_care_gaps", "gap_type", list(GAP_MEASURES)),
            (
                "mart_provider_efficiency",
                "efficiency_quadrant",
                ["Complex High Cost", "Complex Managed", "High Value", "Low Value"],
            ),
        ]
    ],
)
_verdicts(
    "accepted_range",
    [
        (table, column, f"select count(*) from {_DATASET_STEP[table]} where not ({column} {condition})")
        for table, column, condition in [
            ("stg_members", "total_healthcare_expenses", ">= 0"),
            ("stg_encounters", "paid_amount", ">= 0"),
            ("stg_medications", "total_drug_cost", ">= 0"),
            ("int_member_chronic_flags", "hcc_risk_score", "between 0 and 5"),
            ("mart_member_risk_profile", "hcc_risk_score", "between 0 and 5"),
            ("mart_member_risk_profile", "condition_count", "between 0 and 20"),
            ("mart_member_risk_profile", "cost_pmpm", ">= 0"),
            ("mart_member_risk_profile", "total_healthcare_expenses", ">= 0"),
            ("mart_care_gaps", "gap_open", "between 0 and 1"),
            ("mart_cost_utilization", "member_count", ">= 1"),
            ("mart_cost_utilization", "avg_cost_pmpm", ">= 0"),
            ("mart_cost_utilization", "pct_of_population", "between 0 and 100"),
            ("mart_provider_efficiency", "attributed_member_count", ">= 5"),
        ]
    ],
)
_RAW_KEY = {
    "PATIENT": "patient",
    "CODE": "code",
    "START": "start_date",
    "ENCOUNTER": "encounter",
    "STOP": "stop_date",
    "TOTALCOST": "total",
    "PAYER": "payer",
    "BASE_COST": "base",
}
expect(
    "dq_duplicate_keys",
    "medications",
    "t:key_columns i:duplicate_groups",
    "from ("
    + " union all ".join(
        f"select {text(', '.join(list(_RAW_KEY)[:n]))} as key_columns, (select count(*) from (select 1 from medications"
        f" group by {', '.join(list(_RAW_KEY.values())[:n])} having count(*) > 1)) as duplicate_groups"
        for n in (3, 4, 6, 8)
    )
    + ")",
)
expect(
    "dq_row_counts",
    "",
    "t:table_name i:row_count",
    "from (" + " union all ".join(f"select {text(t)} as table_name, (select count(*) from {t}) as row_count" for t in STAR_SCHEMAS) + ")",
)
step(
    "history",
    "",
    """select cast(o_orderdate as date) as run_date, 'row_count' as check_type, 'orders_' || left(o_orderpriority, 1) as table_name,
         cast(null as varchar) as column_name, count(*) as row_count, cast(null as double) as null_rate_pct
       from orders group by all
       union all
       select distinct cast(o_orderdate as date), 'null_rate', 'orders', 'o_custkey', null, 0.0 from orders""",
)
expect(
    "dq_prior_run_counts",
    "history",
    "t:table_name i:row_count",
    "from history where check_type = 'row_count' and run_date = (select max(run_date) from history)",
)
expect(
    "dq_row_count_drop",
    "history",
    "t:table_name i:row_count i:prior_count d:drop_pct t:check_result",
    f"""from (select table_name, row_count, prior_count,
          case when prior_count > 0 then {ratio("(prior_count - row_count) * 100", "prior_count", 3)} end as drop_pct,
          if(prior_count > 0 and prior_count - row_count > prior_count * 0.1, 'fail', 'pass') as check_result
        from (select c.table_name, c.row_count, coalesce(b.row_count, c.row_count) as prior_count
              from (select table_name, row_count from history
                    where check_type = 'row_count' and run_date = (select max(run_date) from history)
                    union all select 'lineitem', count(*) from lineitem) c
              left join (select table_name, row_count from history
                    where check_type = 'row_count' and run_date = (select max(run_date) from history
                          where run_date < (select max(run_date) from history))) b using (table_name)))""",
)
_MART_NULLS = [
    ("mart_member_risk_profile", ["member_id", "risk_tier", "measurement_year", "hcc_risk_score"]),
    ("mart_care_gaps", ["member_id", "gap_type", "gap_open", "measurement_year"]),
    ("mart_cost_utilization", ["risk_tier", "member_count", "avg_cost_pmpm"]),
    ("mart_provider_efficiency", ["provider_npi", "attributed_member_count"]),
]


def _null_rates(tables: list[tuple[str, list[str]]]) -> str:
    return " union all ".join(
        f"""select {text(table)} as table_name, {text(column)} as column_name, count(*) - count({column}) as null_rows,
              count(*) as row_count, {ratio(f"(count(*) - count({column})) * 100", "count(*)", 3)} as null_rate_pct,
              case when count(*) = 0 then 'empty' when count(*) - count({column}) > count(*) * 0.01 then 'fail'
                   else 'pass' end as check_result from {_DATASET_STEP[table]}"""
        for table, columns in tables
        for column in columns
    )


expect(
    "dq_null_rates",
    "profile gaps cost efficiency visits",
    "t:table_name t:column_name i:null_rows i:row_count d:null_rate_pct t:check_result",
    f"from ({_null_rates([*_MART_NULLS, ('stg_encounters', ['provider_id', 'reason_snomed_code'])])})",
)
expect(
    "dq_freshness",
    "visits services",
    "t:table_name t:column_name t:max_date i:days_stale t:check_result",
    f"""from (select table_name, column_name, max_date, date '{AS_OF}' - max_date as days_stale,
          if(date '{AS_OF}' - max_date > days_allowed, 'fail', 'pass') as check_result
        from (select 'stg_encounters' as table_name, 'service_date' as column_name, max(service_date) as max_date,
                90 as days_allowed from visits
              union all select 'stg_procedures', 'procedure_date', max(procedure_date), 60 from services))""",
)
expect(
    "dq_stored_freshness",
    "visits services",
    "t:table_name t:column_name t:max_date i:days_stale t:check_result i:row_count",
    f"""from (select table_name, column_name, max_date, date '{AS_OF}' - max_date as days_stale, row_count,
          if(date '{AS_OF}' - max_date > days_allowed, 'fail', 'pass') as check_result
        from (select 'stg_encounters' as table_name, 'service_date' as column_name, max(service_date) as max_date, count(*) as row_count,
                90 as days_allowed from visits
              union all select 'stg_procedures', 'procedure_date', max(procedure_date), count(*), 60 from services))""",
)
_CONTRACT = {
    "patients": (
        "Id:string:id BIRTHDATE:date:born DEATHDATE:date:died GENDER:string:gender RACE:string:race"
        " ETHNICITY:string:ethnicity STATE:string:state CITY:string:city ZIP:string:zip"
        " HEALTHCARE_EXPENSES:decimal(18,2):expenses HEALTHCARE_COVERAGE:decimal(18,2):coverage"
    ),
    "encounters": (
        "Id:string:id PATIENT:string:patient PROVIDER:string:provider PAYER:string:payer START:timestamp:start_ts"
        " STOP:timestamp:stop_ts ENCOUNTERCLASS:string:class REASONCODE:string:reason"
        " REASONDESCRIPTION:string:reason_text CODE:string:code DESCRIPTION:string:description"
        " BASE_ENCOUNTER_COST:decimal(18,2):base TOTAL_CLAIM_COST:decimal(18,2):total"
        " PAYER_COVERAGE:decimal(18,2):covered"
    ),
    "conditions": (
        "PATIENT:string:patient ENCOUNTER:string:encounter START:date:start_date STOP:date:stop_date CODE:string:code"
        " DESCRIPTION:string:description"
    ),
    "procedures": (
        "PATIENT:string:patient ENCOUNTER:string:encounter DATE:date:done_on CODE:string:code"
        " DESCRIPTION:string:description BASE_COST:decimal(18,2):price"
    ),
    "medications": (
        "PATIENT:string:patient ENCOUNTER:string:encounter PAYER:string:payer START:date:start_date"
        " STOP:date:stop_date CODE:string:code DESCRIPTION:string:description BASE_COST:decimal(18,2):base"
        " PAYER_COVERAGE:decimal(18,2):covered TOTALCOST:decimal(18,2):total DISPENSES:bigint:dispensed"
        " REASONCODE:string:reason REASONDESCRIPTION:string:reason_text"
    ),
    "providers": "Id:string:id",
}
expect(
    "dq_schema_contract",
    " ".join(_DATASET_STEP[table] for table in _CONTRACT),
    "t:table_name t:column_name t:expected_type t:actual_type t:status i:filled_rows",
    "from ("
    + " union all ".join(
        f"select {text(table)} as table_name, {text(name)} as column_name, {text(kind)} as expected_type,"
        f" {text(kind)} as actual_type, 'ok' as status, count({source}) as filled_rows from {_DATASET_STEP[table]}"
        for table, spec in _CONTRACT.items()
        for name, kind, source in (item.split(":") for item in spec.split())
    )
    + ")",
)
_AUDIT_COLUMNS = (
    "t:run_timestamp t:run_id t:check_type t:table_name t:column_name t:check_result i:row_count d:null_rate_pct t:details"
)
expect(
    "dq_audit_rows",
    "profile gaps cost efficiency visits services supply",
    _AUDIT_COLUMNS,
    f"""from (select timestamp '2001-12-31 06:00:00' as run_timestamp, 'run-2001' as run_id, * from (
          select 'row_count' as check_type, table_name, cast(null as varchar) as column_name,
            if(prior_count - row_count > prior_count * 0.1, 'fail', 'pass') as check_result, row_count,
            cast(null as double) as null_rate_pct, 'row_count=' || row_count as details
          from (select 'mart_member_risk_profile' as table_name, count(*) as row_count, (select count(*) from visits) as prior_count from profile
                union all select 'mart_care_gaps', count(*), (select count(*) from services) from gaps
                union all select 'mart_cost_utilization', count(*), (select count(distinct claim_type) from visits) from cost
                union all select 'mart_provider_efficiency', count(*), (select count(*) from supply) from efficiency)
          union all
          select 'null_rate', table_name, column_name, check_result, null, null_rate_pct,
            'null_rate=' || cast(cast(null_rate_pct as decimal(28,3)) as varchar) || '%'
          from ({_null_rates(_MART_NULLS)})
          union all
          select 'freshness', 'stg_encounters', 'service_date',
            if(date '{AS_OF}' - max(service_date) > 90, 'fail', 'pass'), null, null,
            'max_date=' || cast(max(service_date) as varchar) || ', days_stale=' || (date '{AS_OF}' - max(service_date))
          from visits))""",
)
expect(
    "audit_retention",
    "history",
    "t:run_timestamp t:run_id t:check_type t:table_name t:column_name t:check_result i:row_count d:null_rate_pct t:run_date",
    f"""from (select cast(run_date as timestamp) as run_timestamp, 'run-' || cast(run_date as varchar) as run_id, check_type,
          table_name, column_name, 'pass' as check_result, row_count, null_rate_pct, run_date
        from history where run_date >= date '{AS_OF}' - 365)""",
)

# Reports

_TIER_POSITION = "list_position([" + text_list(RISK_TIERS) + "], risk_tier)"
_GAP_TITLES = {
    "diabetes_a1c": "Diabetes A1C",
    "diabetes_eye_exam": "Diabetes Eye Exam",
    "high_risk_med_review": "High Risk Med Review",
    "readmission_30d": "Readmission 30D",
}
_GAP_TITLE = "case gap_type " + " ".join(f"when {text(k)} then {text(v)}" for k, v in _GAP_TITLES.items()) + " end"

step("tiered_gaps", "gaps profile", "select g.*, p.risk_tier from gaps g left join profile p using (member_id)")
step("shown", "efficiency", "select * from efficiency order by attributed_member_count desc, provider_npi")

expect(
    "report_population_kpis",
    "profile",
    "i:total_members i:high_risk_members d:high_risk_pct d:avg_hcc_score d:avg_cost_pmpm",
    f"""from (select count(*) as total_members, count(*) filter (where risk_tier = 'high') as high_risk_members,
          cast(count(*) filter (where risk_tier = 'high') as double) * 100.0 / cast(count(*) as double) as high_risk_pct,
          {mean("hcc_risk_score", 6)} as avg_hcc_score, {mean("cost_pmpm", 6)} as avg_cost_pmpm from profile)""",
)
expect(
    "report_tier_distribution",
    "profile",
    "i:tier_rank t:risk_tier i:member_count",
    f"""from (select {_TIER_POSITION} as tier_rank, risk_tier,
          (select count(*) from profile p where p.risk_tier = tiers.risk_tier) as member_count
        from (values {", ".join(f"({text(t)})" for t in RISK_TIERS)}) tiers(risk_tier))""",
)
expect(
    "report_top_conditions",
    "profile",
    "t:flag t:condition d:prevalence d:prevalence_pct",
    "from (select flag, "
    + title("substr(flag, 4)")
    + " as condition, prevalence, prevalence * 100 as prevalence_pct from ("
    + " union all ".join(f"select {text(flag)} as flag, {mean(flag, 6)} as prevalence from profile" for flag in FLAGS)
    + ") order by prevalence desc, flag)",
)
expect(
    "report_hcc_box",
    "profile",
    "t:risk_tier d:q1 d:median d:q3 i:member_count d:lower_whisker d:upper_whisker i:outlier_count",
    """from (select s.risk_tier, b.q1, b.median, b.q3, count(*) as member_count,
         min(s.hcc_risk_score) filter (where s.hcc_risk_score between b.low and b.high) as lower_whisker,
         max(s.hcc_risk_score) filter (where s.hcc_risk_score between b.low and b.high) as upper_whisker,
         count(*) filter (where s.hcc_risk_score not between b.low and b.high) as outlier_count
       from (select * from profile where hcc_risk_score > 0) s
       join (select *, q1 - 1.5 * (q3 - q1) as low, q3 + 1.5 * (q3 - q1) as high from (
               select risk_tier, cast(quantile_cont(cast(hcc_risk_score as double), 0.25) as decimal(18,6)) as q1,
                 cast(quantile_cont(cast(hcc_risk_score as double), 0.5) as decimal(18,6)) as median,
                 cast(quantile_cont(cast(hcc_risk_score as double), 0.75) as decimal(18,6)) as q3
               from profile where hcc_risk_score > 0 group by risk_tier)) b on b.risk_tier = s.risk_tier
       group by s.risk_tier, b.q1, b.median, b.q3)""",
)


def _interpolated(share: str) -> str:
    """Exact quantile of ranked rows (rank r from 0, n rows): both neighbours of the position, weighted in ten-thousandths."""
    position = f"((n - 1) * {round(float(share) * 10_000)})"
    first, second = f"max(cents) filter (where r = {position} // 10000)", f"max(cents) filter (where r = {position} // 10000 + 1)"
    part = f"max({position} % 10000)"
    return f"cast({first} * 10000 + (coalesce({second}, {first}) - {first}) * {part} as decimal(28,0)) * cast(0.000001 as decimal(7,6))"


expect(
    "report_claim_cost_box",
    "visits",
    "t:provider_id d:q1 d:median d:q3 i:claim_count d:lower_whisker d:upper_whisker i:outlier_count",
    f"""from (select s.provider_id, b.q1, b.median, b.q3, count(*) as claim_count,
         min(s.paid_amount) filter (where s.paid_amount between b.low and b.high) as lower_whisker,
         max(s.paid_amount) filter (where s.paid_amount between b.low and b.high) as upper_whisker,
         count(*) filter (where s.paid_amount not between b.low and b.high) as outlier_count
       from visits s
       join (select *, q1 - 1.5 * (q3 - q1) as low, q3 + 1.5 * (q3 - q1) as high from (
               select provider_id, {_interpolated("0.25")} as q1, {_interpolated("0.5")} as median, {_interpolated("0.75")} as q3
               from (select provider_id, cast(paid_amount * 100 as bigint) as cents, count(*) over (partition by provider_id) as n,
                       row_number() over (partition by provider_id order by paid_amount) - 1 as r
                     from visits where provider_id is not null) group by provider_id)) b on b.provider_id = s.provider_id
       group by s.provider_id, b.q1, b.median, b.q3)""",
)
expect("report_gaps_with_tier", "tiered_gaps", f"{_GAP} t:risk_tier")
expect(
    "report_gap_kpis",
    "tiered_gaps",
    "i:gap_opportunities i:open_gaps d:open_rate_pct d:high_risk_open_rate_pct",
    f"""from (select count(*) as gap_opportunities, sum(gap_open) as open_gaps,
          {ratio("sum(gap_open) * 100", "count(*)", 6)} as open_rate_pct,
          {ratio("sum(gap_open) filter (where risk_tier = 'high') * 100", "count(*) filter (where risk_tier = 'high')", 6)}
            as high_risk_open_rate_pct from tiered_gaps)""",
)
expect(
    "report_gap_rate_by_tier",
    "tiered_gaps",
    "t:gap_type t:risk_tier d:gap_rate_pct t:gap_type_label",
    f"""from (select gap_type, risk_tier, {ratio("sum(gap_open) * 100", "count(*)", 6)} as gap_rate_pct,
          {_GAP_TITLE} as gap_type_label from tiered_gaps group by gap_type, risk_tier)""",
)
expect(
    "report_gap_summary",
    "tiered_gaps",
    "t:gap_type i:eligible_members i:open_gaps d:gap_rate_pct t:gap_type_label",
    f"""from (select gap_type, count(distinct member_id) as eligible_members, sum(gap_open) as open_gaps,
          {ratio_even("sum(gap_open) * 100", "count(*)", 1)} as gap_rate_pct, {_GAP_TITLE} as gap_type_label
        from tiered_gaps group by gap_type)""",
)
expect(
    "report_gap_heatmap",
    "tiered_gaps",
    "i:tier_rank t:risk_tier " + " ".join(f"d:{gap}" for gap in GAP_MEASURES),
    "from (select "
    + _TIER_POSITION
    + " as tier_rank, risk_tier, "
    + ", ".join(
        ratio(f"sum(gap_open) filter (where gap_type = {text(gap)}) * 100", f"count(*) filter (where gap_type = {text(gap)})", 6)
        + f" as {gap}"
        for gap in GAP_MEASURES
    )
    + " from tiered_gaps group by risk_tier)",
)
expect(
    "report_cost_kpis",
    "cost",
    "d:total_cost d:high_pmpm d:cost_ratio",
    f"""from (select sum(total_cost_ytd) as total_cost, max(avg_cost_pmpm) filter (where risk_tier = 'high') as high_pmpm,
          {ratio("max(avg_cost_pmpm) filter (where risk_tier = 'high')",
                 "cast(max(avg_cost_pmpm) filter (where risk_tier = 'low') as double)", 6)} as cost_ratio from cost)""",
)
expect(
    "report_cost_by_tier",
    "cost",
    "i:measurement_year i:tier_rank t:risk_tier d:avg_cost_pmpm",
    f"from (select *, {_TIER_POSITION} as tier_rank from cost)",
)
expect(
    "report_utilization_by_tier",
    "cost",
    "i:tier_rank t:risk_tier t:visit_type d:per_1000",
    f"""from (select {_TIER_POSITION} as tier_rank, risk_tier, 'IP' as visit_type, ip_admits_per_1000 as per_1000 from cost
        union all select {_TIER_POSITION}, risk_tier, 'ER', er_visits_per_1000 from cost)""",
)
expect(
    "report_member_sample",
    "profile",
    "t:member_id d:hcc_risk_score d:cost_pmpm t:risk_tier i:condition_count i:age_at_year_end",
    "from profile where ('0x' || substr(md5(member_id || '-42'), 1, 8))::bigint < 1073741824",
)
expect(
    "report_key_insight",
    "cost",
    "t:risk_tier d:avg_cost_pmpm d:pct_of_population",
    f"from (select * from cost order by avg_cost_pmpm desc, {_TIER_POSITION} limit 1)",
)
expect("report_top_providers", "shown", _QUADRANT)
expect(
    "report_provider_kpis",
    "shown",
    "i:providers i:high_value_providers d:avg_gap_closure_pct",
    f"""from (select count(*) as providers, count(*) filter (where efficiency_quadrant = 'High Value') as high_value_providers,
          {mean("gap_closure_rate_pct", 6)} as avg_gap_closure_pct from shown)""",
)
expect(
    "report_provider_quadrant_points",
    "shown",
    "t:provider_npi d:avg_hcc_score d:avg_cost_pmpm i:attributed_member_count t:efficiency_quadrant"
    " d:gap_closure_rate_pct t:top_condition d:shown_median_cost d:shown_median_hcc",
    """from (select s.*, m.* from shown s, (
         select cast(quantile_cont(cast(avg_cost_pmpm as double), 0.5) as decimal(28,6)) as shown_median_cost,
           cast(quantile_cont(cast(avg_hcc_score as double), 0.5) as decimal(28,6)) as shown_median_hcc from shown) m)""",
)
expect(
    "report_provider_scorecard",
    "shown",
    "t:npi i:members d:avg_pmpm d:avg_hcc_score d:gap_closure_pct t:top_condition t:quadrant",
    """from (select provider_npi as npi, attributed_member_count as members, round_even(avg_cost_pmpm, 0) as avg_pmpm,
         avg_hcc_score, gap_closure_rate_pct as gap_closure_pct, top_condition, efficiency_quadrant as quadrant from shown)""",
)

# The report of the year before, over marts stored for two years: the same SQL with that year and its last day.
ORACLES["report_stored_cost_by_tier"] = ORACLES["report_cost_by_tier"].replace(str(YEAR), str(YEAR - 1))
