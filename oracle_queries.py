"""The registered queries in SQL, straight from the ``events`` table: the check values of the tests."""

from __future__ import annotations

# All occurrences, flat: what the landed pages must read as.
_ALL = r"""
with e as (
  select event_id as h, event_id // 3 as k, ts, user_id as u, event_type as et,
         cast((event_id * 13) % 101 as double) / 10 as s,
         event_id // 500 as pg, count(*) over () as total,
         cast(greatest(3, length(cast((select max(event_id) // 500 from events) as varchar))) as int) as w
  from events),
e2 as (
  select *,
    case when s >= 9 then 'CRITICAL' when s >= 7 then 'HIGH' when s >= 4 then 'MEDIUM' else 'LOW' end as sev,
    case when s >= 7 then 'HIGH' when s >= 4 then 'MEDIUM' else 'LOW' end as sev2
  from e),
f as (
  select h, total, pg,
    case when h % 97 = 0 then null else 'CVE-2024-' || lpad(cast(k as varchar), 6, '0') end as cve_id,
    case when h % 89 = 0 then null when h % 83 = 0 then 'not-a-date' else strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') end as published,
    case when h % 89 = 0 or h % 83 = 0 then null else date_trunc('millisecond', ts) end as published_at,
    case when h % 101 = 0 then null
         else date_trunc('day', ts) + to_days(case when k % 10 = 0 then 5 else cast((h * 2) % 3 as int) end) end as modified_at,
    case h % 3 when 0 then 'Analyzed' when 1 then 'Modified' else 'Awaiting Analysis' end as vuln_status,
    'src' || (u % 10) || '@example.org' as source_identifier,
    case when h % 7 = 0 or h % 5 = 0 then null else repeat(et || ' ', cast(1 + h % 90 as int)) end as description_en,
    case when h % 6 in (0, 1, 4) then s end as cvss_v31_score,
    case when h % 6 in (0, 1, 4) then sev end as cvss_v31_severity,
    case when h % 6 in (0, 1, 4) then 'CVSS:3.1/S:' || cast(s as varchar) end as cvss_v31_vector,
    case when h % 6 = 2 then s end as cvss_v30_score,
    case when h % 6 = 2 then sev end as cvss_v30_severity,
    case when h % 6 in (3, 4) then s end as cvss_v2_score,
    case when h % 6 in (3, 4) then sev2 end as cvss_v2_severity,
    case h % 4 when 0 then null when 1 then ['CWE-' || (u % 25)] when 2 then ['CWE-' || (u % 25), 'NVD-CWE-noinfo']
         else [null, 'CWE-' || (u % 7)] end as cwes,
    case when h % 4 = 3 then null else cast(h % 4 as int) end as nrefs,
    case h % 4 when 1 then 'http://r/' || h || '/0' when 2 then 'http://r/' || h || '/0,http://r/' || h || '/1' else '' end as reference_urls,
    'cves_20240101_20240130_p' || lpad(cast(pg as varchar), w, '0') || '_20240131T000000Z.json' as ingest_file,
    cast(h % 500 as int) as position
  from e2),
g as (select * from f where cve_id is not null and published_at is not null and modified_at is not null),
silver as (select * from g qualify row_number() over (partition by cve_id order by modified_at desc, h desc) = 1)
"""

def _stamp(name: str) -> str:
    return f"""strftime("{name}", '%Y-%m-%d %H:%M:%S.%f') as "{name}\""""


_CWES = "coalesce(array_to_string(list_filter(cwes, lambda x: x is not null), ','), '') as cwe_ids"
_SILVER_COLUMNS = f"""
cve_id, {_stamp('published_at')}, {_stamp('modified_at')}, vuln_status, source_identifier, description_en, cvss_v31_score, cvss_v31_severity,
cvss_v31_vector, cvss_v30_score, cvss_v30_severity, cvss_v2_score, cvss_v2_severity, {_CWES}, reference_urls, ingest_file
"""
_SEVERITY = "coalesce(cvss_v31_severity, cvss_v30_severity, cvss_v2_severity)"
_SCORE = "coalesce(cvss_v31_score, cvss_v30_score, cvss_v2_score)"

_COUNTS = """
select expectation, sum(cast(ok as int))::bigint as passed_records, sum(cast(not ok as int))::bigint as failed_records
from (select 'valid_cve_id' as expectation, cve_id is not null as ok from f
      union all select 'valid_published', published_at is not null from f
      union all select 'valid_modified', modified_at is not null from f)
group by 1
"""

# One row per landed page of the two runs with one window per day; of a page cut short, nothing but its name is known.
_INDEX = """
with e as (
  select event_id, cast(ts as date) as d, cast(ts as date) - date '2024-01-01' as n,
         row_number() over (partition by cast(ts as date) order by event_id) as rn,
         count(*) over (partition by cast(ts as date)) as total
  from events),
p as (
  select d as chunk_start, d + 1 as chunk_end, n, cast((rn - 1) // 10 as int) as page, total, count(*) as records
  from e group by all),
idx as (
  select '20240131T000000Z' as run_ts, chunk_start, chunk_end, page, n % 13 = 4 and page = 0 as cut,
         case when n % 13 = 4 and page = 0 then null else total end as total,
         case when n % 13 = 4 and page = 0 or n % 13 = 6 and page = 2 then 0 else records end as records
  from p where not (n % 7 = 3 and page = 1) and n % 11 <> 5
  union all
  select '20240201T000000Z', chunk_start, chunk_end, page, false, total, records from p where n % 9 = 0)
"""

_EVENTS = """
with c as (
  select ts as "timestamp", 'events' as source, 'user-' || user_id as asset,
         event_type || ':' || json_extract_string(props, '$.k') as indicator,
         case when value >= 100 then 'CRITICAL' when value >= 50 then 'HIGH' when value >= 10 then 'MEDIUM' else 'LOW' end as severity,
         props as raw, event_type, value
  from events),
m as (
  select 'R1' as rule_id, 'HIGH' as severity, 'TECH-1' as technique, asset, cast("timestamp" as date) as d from c where event_type = 'error' and value >= 50
  union all select 'R2', 'CRITICAL', 'TECH-2', asset, cast("timestamp" as date) from c where value >= 100
  union all select 'R3', 'LOW', 'TECH-3', asset, cast("timestamp" as date) from c where indicator = 'click:13'
  union all select 'R4', 'LOW', 'TECH-4', asset, cast("timestamp" as date) from c where value < 0),
alerts as (
  select sha256(length(rule_id) || ':' || rule_id || coalesce(length(asset) || ':' || asset, ':') || coalesce(length(cast(cast(d as date) as varchar)) || ':' || cast(cast(d as date) as varchar), ':')) as alert_id, rule_id, severity, technique, asset,
         cast(d as varchar) as day, count(*) as matched_rows
  from m group by rule_id, severity, technique, asset, d)
"""


def _then(first: str, second: str) -> str:
    """Two WITH lists as one."""
    return first.rstrip() + "," + second.strip()[len("with") :]


_TRIAGE = (
    _then(_ALL, _EVENTS)
    + f""",
context as (
  select source_identifier, count(*) as related_cves, count(*) filter ({_SEVERITY} = 'CRITICAL') as critical_cves,
         max({_SCORE}) as worst_score, arg_max(cve_id, ({_SCORE} * 10000000000 + cast(substr(cve_id, 10) as bigint))) as worst_cve
  from silver group by 1),
j as (
  select a.*, coalesce(related_cves, 0) as related_cves, coalesce(critical_cves, 0) as critical_cves, worst_score, worst_cve,
         least(4, case severity when 'LOW' then 1 when 'MEDIUM' then 2 when 'HIGH' then 3 else 4 end
                  + case when coalesce(critical_cves, 0) > 0 then 1 else 0 end) as r
  from alerts a left join context on source_identifier = 'src' || (cast(substr(asset, 6) as bigint) % 10) || '@example.org')
select alert_id, rule_id, severity, asset, day, matched_rows, technique, related_cves, critical_cves, worst_score, worst_cve,
       ['LOW', 'MEDIUM', 'HIGH', 'CRITICAL'][r] as severity_calibrated,
       ['monitor', 'review', 'investigate', 'isolate'][r] as recommended_action,
       (40 + least(matched_rows * 10, 30) + case when critical_cves > 0 then 20 else 0 end) / 100.0::double as confidence,
       rule_id || ' on ' || asset || ' (' || matched_rows || ' rows); ' || related_cves || ' related CVEs, ' || critical_cves || ' critical' as summary
from j
"""
)


_CONFORMED_CVE = f"""strftime(modified_at, '%Y-%m-%d %H:%M:%S.%f') as "timestamp", 'cves' as source, source_identifier as asset,
               cve_id as indicator, {_SEVERITY} as severity"""
_CONFORMED_ZEEK = """strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as "timestamp", 'zeek' as source, '10.0.' || (user_id % 250) || '.7' as asset,
               '192.0.2.' || (event_id % 250) || ':' || case when event_type = 'error' then '22' else '443' end as indicator,
               case when event_type = 'error' then 'MEDIUM' else 'LOW' end as severity"""
_IMAGE = r"'C:\bin\' || event_type || '.exe'"
_CONFORMED_SYSMON = f"""strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f') as "timestamp", 'sysmon' as source, 'HOST-' || user_id as asset,
               {_IMAGE} as indicator, case when event_type = 'error' then 'HIGH' else 'MEDIUM' end as severity"""
_TECHNIQUES = """select 'T' || event_id as technique_id, event_type || ' ' || event_id as name, event_type as tactics,
               'attack-pattern--' || event_id as stix_id
             from events where event_id % 5 <> 4 and event_id % 7 <> 0 and event_id % 11 <> 0"""


_TAKEN_IN = r"""with r as (select *, event_id // 500 as pg, event_id % 50 as m, lpad(cast(event_id // 500 as varchar), 6, '0') as no from events),
    lines as (select *, 'log_' || no || '.log' as ingest_file from r union all select *, 'copy_' || no || '.log' from r where pg % 5 = 0),
    conns as (
      select *, case when pg % 3 = 2 then 'dns' else 'conn' end as path, '10.0.' || (user_id % 250) || '.7' as asset,
             case when pg % 3 = 2 then event_type || '.example.org' else '192.0.2.' || (event_id % 250) || ':' || case when event_type = 'error' then '22' else '443' end end as indicator,
             case when event_type = 'error' then 'MEDIUM' else 'LOW' end as severity,
             cast(epoch_us(ts) // 1000000 as varchar) || '.' || lpad(cast(epoch_us(ts) % 1000000 as varchar), 6, '0') as seconds
      from lines),
    ends as (select *, 'HOST-' || user_id as asset, 'C:\bin\' || event_type || '.exe' as indicator, case when event_type = 'error' then 'HIGH' else 'MEDIUM' end as severity from r)
"""
_MS = "strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f')"


def all_sql() -> dict[str, str]:
    flat = _ALL + f"select {_SILVER_COLUMNS}"
    return {
        "bronze_pages": _ALL
        + """select ingest_file as file_name, '2024-01-01' as chunk_start, '2024-01-30' as chunk_end, cast(pg as int) as page,
               '20240131T000000Z' as run_ts, cast(500 as bigint) as results_per_page, pg * 500 as start_index, total, count(*) as records
             from f group by ingest_file, pg, total""",
        "bronze_occurrences": _ALL
        + """select ingest_file, position, cve_id, published,
               strftime(modified_at, '%Y-%m-%dT%H:%M:%S.%g') as last_modified from f""",
        "cves_flat": flat + ", position from f",
        "description_first_en": _ALL + "select ingest_file, position, cve_id, description_en from f",
        "cwe_ids_distinct": _ALL
        + f"select ingest_file, position, cve_id, {_CWES}, cast(len(cwes) as varchar) as cwe_entries from f",
        "reference_counts": _ALL + "select ingest_file, position, cve_id, cast(nrefs as varchar) as reference_count from f",
        "cves_valid": flat + ", position from g",
        "dq_expectation_metrics": _ALL + _COUNTS,
        "dq_event_log": _ALL + _COUNTS,
        "dq_quarantine": _ALL
        + """select ingest_file, position, cve_id,
               concat_ws(',', case when cve_id is null then 'valid_cve_id' end, case when published_at is null then 'valid_published' end,
                              case when modified_at is null then 'valid_modified' end) as failed_rules
             from f where cve_id is null or published_at is null or modified_at is null""",
        "cves_scd1": flat + " from silver",
        "cves_scd1_stream": flat + " from silver",
        "cves_continuous": flat + " from silver",
        "cve_severity_daily": _ALL
        + f"""select cast(cast(published_at as date) as varchar) as day, coalesce({_SEVERITY}, 'UNKNOWN') as severity,
               count(*) as cve_count from silver group by all""",
        "cve_recent_critical": _ALL
        + f"""select cve_id, {_stamp('published_at')}, {_stamp('modified_at')}, {_SCORE} as cvss_score, {_SEVERITY} as cvss_severity,
               cvss_v31_vector as cvss_vector, substring(description_en, 1, 280) as description_short, {_CWES},
               cast(nrefs as varchar) as reference_count, vuln_status
             from silver where {_SEVERITY} = 'CRITICAL' and published_at >= date '2024-01-31' - 20""",
        "cve_cwe_top": _ALL
        + r"""select c as cwe_id, count(*) as cve_count from (select unnest(cwes) as c from silver)
              where regexp_matches(c, '^CWE-\d+$') group by 1""",
        "gold_published": _ALL
        + rf"""select 'cve_severity_daily' as report, cast(cast(published_at as date) as varchar) || '|' || coalesce({_SEVERITY}, 'UNKNOWN') as item,
               count(*) as counted from silver group by all
             union all select 'cve_recent_critical', concat_ws('|', cve_id, vuln_status, substring(description_en, 1, 280)), 1 from silver
               where {_SEVERITY} = 'CRITICAL' and published_at >= date '2024-01-31' - 90
             union all select 'cve_cwe_top', c, count(*) from (select unnest(cwes) as c from silver)
               where regexp_matches(c, '^CWE-\d+$') group by c""",
        "cvss_best": _ALL
        + """select cve_id,
               case when cvss_v31_score is not null then '3.1' when cvss_v30_score is not null then '3.0' when cvss_v2_score is not null then '2.0' end as cvss_version,
               coalesce(cvss_v31_score, cvss_v30_score, cvss_v2_score) as cvss_score,
               coalesce(cvss_v31_severity, cvss_v30_severity, cvss_v2_severity) as cvss_severity, cvss_v31_vector as cvss_vector
             from silver""",
        "top_sources": _ALL
        + f"""select source_identifier, count(*) as cve_count, count(*) filter ({_SEVERITY} = 'CRITICAL') as critical_count
             from silver group by 1""",
        "trending_cves": _ALL
        + """, d as (select cve_id, cast(modified_at as date) as day, count(*) as occurrences from g group by all),
             t as (select *, coalesce(sum(occurrences) over (partition by cve_id order by day
                     range between interval 7 days preceding and interval 1 day preceding), 0) / 7.0::double as trailing_mean from d)
             select cve_id, cast(cast(day as date) as varchar) as day, occurrences, trailing_mean from t where occurrences > trailing_mean""",
        "landing_totals": "select count(distinct event_id // 500) as files from events",
        "ingest_summary": _INDEX
        + """select run_ts, cast(chunk_start as varchar) as chunk_start, cast(chunk_end as varchar) as chunk_end, count(*) as files,
               sum(records)::bigint as records from idx group by all""",
        "page_completeness": _INDEX
        + """, c as (select run_ts, cast(chunk_start as varchar) as chunk_start, cast(chunk_end as varchar) as chunk_end, count(*) as pages,
                     max(total) as total, sum(records)::bigint as records, count(*) filter (records = 0) as empty_pages,
                     cast(ceil(max(total) / 10.0) as bigint) as expected_pages
                     from idx group by all)
             select * from c where pages < expected_pages or records < total or total is null""",
        "window_gaps": _INDEX
        + """, o as (select run_ts, chunk_start, lag(chunk_end) over (partition by run_ts order by chunk_start) as prev
                     from (select distinct run_ts, chunk_start, chunk_end from idx))
             select run_ts, cast(prev as varchar) as gap_start, cast(chunk_start as varchar) as gap_end,
                    cast(chunk_start - prev as int) as gap_days
             from o where prev < chunk_start""",
        "window_gaps_across_runs": _INDEX
        + """, o as (select chunk_start, lag(chunk_end) over (order by chunk_start) as prev from (select distinct chunk_start, chunk_end from idx))
             select cast(prev as varchar) as gap_start, cast(chunk_start as varchar) as gap_end, cast(chunk_start - prev as int) as gap_days
             from o where prev < chunk_start""",
        "corrupt_pages": _INDEX
        + """select 'cves_' || strftime(chunk_start, '%Y%m%d') || '_' || strftime(chunk_end, '%Y%m%d') || '_p' || lpad(cast(page as varchar), 3, '0')
                    || '_' || run_ts || '.json' as ingest_file, true as lost, true as kept_text from idx where cut""",
        "schema_evolved": _ALL
        + """select ingest_file, position, cve_id, case when pg % 2 = 1 then 'CVE_PAGE' end as format,
               case when pg % 2 = 1 then event_type else '' end as cve_tags
             from f join events on event_id = h""",
        "ingest_clock": """select cast((event_id // 500) % 2 as int) as step, count(distinct event_id // 500) as pages,
               count(distinct event_id // 500) as clocked, cast(1 as bigint) as clocks from events group by 1""",
        "incremental_window": _ALL
        + f"""select cve_id, {_stamp('modified_at')} from silver
             where modified_at between timestamp '2024-01-19 00:00:00' and timestamp '2024-01-20 00:00:00'""",
        "backfill_window": _ALL
        + f"""select cve_id, {_stamp('modified_at')} from silver
             where modified_at between timestamp '2024-01-06 12:00:00' and timestamp '2024-01-20 12:00:00'""",
        "chunk_counts": _ALL
        + """, w as (select i as chunk, timestamp '2024-01-01' + to_days(cast(7 * i as int)) as b,
                            least(timestamp '2024-01-01' + to_days(cast(7 * i + 7 as int)), timestamp '2024-02-04') as t
                     from range(5) r(i))
             select chunk, strftime(b, '%Y-%m-%dT%H:%M:%S.000') as chunk_start, strftime(t, '%Y-%m-%dT%H:%M:%S.000') as chunk_end,
                    count(*) as "rows", strftime(min(modified_at), '%Y-%m-%d %H:%M:%S.%f') as first_ts, strftime(max(modified_at), '%Y-%m-%d %H:%M:%S.%f') as last_ts
             from w join g on modified_at between b and t group by chunk, b, t""",
        "duplicate_versions": _ALL
        + f"""select cve_id, {_stamp('modified_at')}, count(*) as occurrences, count(distinct ingest_file) as files,
               min(ingest_file) as first_file, max(ingest_file) as last_file
             from g group by cve_id, g.modified_at having count(*) > 1""",
        "conformed_events": _EVENTS + f'select {_stamp("timestamp")}, source, asset, indicator, severity, raw from c',
        "conformed_cves": _ALL + f"select {_CONFORMED_CVE}, {_SILVER_COLUMNS} from silver",
        "conformed_all": _then(_ALL, _EVENTS)
        + f"""select {_CONFORMED_CVE} from silver
             union all select {_stamp("timestamp")}, source, asset, indicator, severity from c
             union all select {_CONFORMED_ZEEK} from events
             union all select {_CONFORMED_SYSMON} from events""",
        "conformed_distinct": _EVENTS + f'select distinct {_stamp("timestamp")}, source, asset, indicator, severity, raw from c',
        "conformed_distinct_stream": _EVENTS + f'select distinct {_stamp("timestamp")}, source, asset, indicator, severity, raw from c',
        "detection_alerts": _EVENTS + "select alert_id, rule_id, severity, asset, day, matched_rows from alerts",
        "cve_alerts": _ALL
        + f""", m as (
               select 'C1' as rule_id, 'CRITICAL' as severity, source_identifier as asset, cast(modified_at as date) as d from silver where {_SCORE} >= 9.0
               union all select 'C2', 'MEDIUM', source_identifier, cast(modified_at as date) from silver
                 where vuln_status = 'Awaiting Analysis' and cvss_v31_severity = 'HIGH'
               union all select 'C3', 'LOW', source_identifier, cast(modified_at as date) from silver where nrefs = 0)
             select sha256(length(rule_id) || ':' || rule_id || coalesce(length(asset) || ':' || asset, ':') || coalesce(length(cast(cast(d as date) as varchar)) || ':' || cast(cast(d as date) as varchar), ':')) as alert_id, rule_id, severity, asset,
                    cast(d as varchar) as day, count(*) as matched_rows
             from m group by rule_id, severity, asset, d""",
        "alert_volume": _EVENTS
        + "select rule_id, day, count(*) as alerts, sum(matched_rows)::bigint as matched_rows from alerts group by rule_id, day",
        "top_iocs": _EVENTS
        + "select indicator, count(*) as sightings from c group by 1 order by sightings desc, indicator limit 20",
        "triage_enriched": _TRIAGE,
        "alerts_triaged": _TRIAGE,
        "catalog_tables": _then(_ALL, _EVENTS)
        + rf"""select 'nvd_cves_raw' as dataset, 'bronze' as quality, 'Landed CVE pages as read, one row per page file' as description,
               count(distinct pg) as "rows" from f
             union all select 'cves', 'silver', 'Current version of each CVE', count(*) from silver
             union all select 'cve_severity_daily', 'gold', 'CVEs per publication day and severity',
               count(distinct (cast(published_at as date), coalesce({_SEVERITY}, 'UNKNOWN'))) from silver
             union all select 'cve_recent_critical', 'gold', 'Critical CVEs of the trailing window', count(*) from silver
               where {_SEVERITY} = 'CRITICAL' and published_at >= date '2024-01-31' - 90
             union all select 'cve_cwe_top', 'gold', 'Weakness categories by number of CVEs', count(distinct c)
               from (select unnest(cwes) as c from silver) where regexp_matches(c, '^CWE-\d+$')
             union all select 'alerts', 'gold', 'Rows that match a detection rule, counted per rule, asset and day', count(*) from alerts
             union all select 'alerts_triaged', 'gold', 'Alerts with CVE and technique context, calibrated severity and confidence', count(*) from alerts""",
        "retained": f"select event_id, {_stamp('ts')} from events where ts >= date '2024-01-31' - 10",
        "conformed_retained": _EVENTS
        + f"""select {_stamp("timestamp")}, asset, indicator, severity, cast(cast(c."timestamp" as date) as varchar) as day
             from c where c."timestamp" >= date '2024-01-31' - 14""",
        "masked_view": f"""select event_id, {_stamp('ts')}, sha256('example' || user_id) as user_id, event_type,
               cast(null as double) as value, cast(null as varchar) as props
             from events where event_type <> 'purchase'""",
        "zeek_conformed": f"""select {_CONFORMED_ZEEK}, 'C' || event_id as uid, value as duration, 'T,F,' || event_id || ',ShADad' as more
             from events""",
        "sysmon_conformed": f"""select {_CONFORMED_SYSMON}, 'CommandLine=run --id ' || event_id || ';DestinationIp=192.0.2.9;Image=' || {_IMAGE}
               || ';User=u' || user_id as items
             from events""",
        "sysmon_json_conformed": f"""select {_CONFORMED_SYSMON}, 'CommandLine=run --id ' || event_id || ';Computer=HOST-' || user_id || ';EventID='
               || case when event_type = 'error' then '8' else '1' end || ';Image=' || {_IMAGE}
               || ';UtcTime=' || strftime(ts, '%Y-%m-%d %H:%M:%S.%g') as items
             from events""",
        "attack_techniques": _TECHNIQUES,
        "triage_techniques": f"""with t as ({_TRIAGE}),
             x as (select * replace (case technique when 'TECH-1' then 'T1' when 'TECH-2' then 'T4' when 'TECH-3' then 'T3' else 'T2' end as technique) from t),
             k as ({_TECHNIQUES})
             select x.*, k.name as technique_name, coalesce(k.tactics, '') as tactics from x left join k on technique = technique_id""",
        "telemetry_conformed": _TAKEN_IN
        + f"""select strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as "timestamp", 'zeek' as source, asset, indicator, severity, ingest_file from conns where m not in (7, 8)
             union all select {_MS}, 'sysmon', asset, indicator, severity, 'endpoint_' || no || x from ends, (values ('.json'), ('.xml')) k(x) where m not in (7, 8)""",
        "telemetry_quarantine": _TAKEN_IN
        + r"""select 'zeek' as kind, case when m = 7 then 'field_count' else 'valid_timestamp' end as failed_rules,
                     case when path = 'conn' and pg % 3 = 1 then left(case when event_type = 'error' then 'REJ' else 'SF' end || '|' ||
                            case when event_id % 4 = 0 then '-' else cast(value as varchar) end || '|' || case event_id % 3 when 0 then '(empty)' when 1 then '-' else 'ssl' end
                            || '|tcp|' || case when event_type = 'error' then '22' else '443' end || '|192.0.2.' || (event_id % 250), 20)
                          else left(case when m = 8 then '-' else seconds end || chr(9) || 'C' || event_id || chr(9) || asset || chr(9) || event_id % 60000 || chr(9) || '192.0.2.', 20) end as begins, ingest_file
              from conns where m in (7, 8)
              union all select 'sysmon_json', case when m = 7 then 'malformed' else 'valid_asset' end,
                     left('{"EventID":' || case when event_type = 'error' then '8' else '1' end || case when m = 7 then ',"Computer"' else ',"UtcTime":' end, 20), 'endpoint_' || no || '.json'
              from ends where m in (7, 8)
              union all select 'sysmon_xml', case when m = 7 then 'malformed' else 'valid_asset' end, '<Event><System><Even', 'endpoint_' || no || '.xml' from ends where m in (7, 8)
              union all select 'sysmon_xml', 'outside_events', 'noise ' || event_id, 'endpoint_' || no || '.xml' from ends where m = 9
              union all select distinct 'attack', 'malformed', '{"type":"bundle","ob', 'bundle_' || no || '.json' from r where pg % 7 = 3""",
        "telemetry_counts": _TAKEN_IN
        + """, z as (select count(*) as n, count(*) filter (m in (7, 8)) as bad, count(distinct ingest_file) as files from conns),
                  e as (select count(*) as n, count(*) filter (m in (7, 8)) as bad, count(*) filter (m = 9) as noise, count(distinct pg) as files from ends),
                  b as (select count(*) filter (pg % 7 <> 3) as n, count(distinct pg) filter (pg % 7 = 3) as bad, count(distinct pg) as files from r)
             select 'zeek' as source, n as records, n - bad as conformed, bad as quarantined, n + 8 * files as raw_records, files from z
             union all select 'sysmon_json', n, n - bad, bad, n, files from e
             union all select 'sysmon_xml', n + noise, n - bad, bad + noise, n + files, files from e
             union all select 'attack', n + bad, n, bad, files, files from b""",
        "telemetry_distinct": _TAKEN_IN
        + """select distinct strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as "timestamp", asset, indicator, severity, 'C' || event_id as uid from conns where m not in (7, 8)""",
        "zeek_by_header": _TAKEN_IN
        + """select ingest_file, path, 'C' || event_id as uid,
                    case when path = 'conn' then case event_id % 3 when 0 then '' when 2 then 'ssl' end end as service,
                    case when path = 'conn' then case when event_type = 'error' then 'REJ' else 'SF' end end as conn_state,
                    case when path = 'dns' then event_type || '.example.org' end as query,
                    case when path = 'dns' then case when event_type = 'error' then 'NXDOMAIN' else 'NOERROR' end end as rcode_name,
                    case when path = 'conn' and event_id % 4 <> 0 then value end as duration,
                    case when path = 'dns' and event_type <> 'error' then '192.0.2.' || (event_id % 250) end as second_answer
             from conns where m <> 7""",
        "attack_taken_in": _TAKEN_IN
        + """select 'T' || event_id as technique_id, event_type || ' ' || event_id as name, 'attack-pattern--' || event_id as stix_id
             from r where pg % 7 <> 3 and event_id % 5 <> 4 and event_id % 7 <> 0""",
        "landing_inventory": _ALL
        + """select ingest_file as file_name, strftime(make_timestamp((1900000000 + pg) * 1000000), '%Y-%m-%d %H:%M:%S.%f') as modified, true as has_size
             from (select distinct ingest_file, pg from f) order by pg desc limit 20""",
        "secured_rows": f"""with seen as (
               select *, 'me' as reader from events where event_type <> 'purchase'
               union all select *, case when length(event_type) % 2 = 1 then 'analyst_a' else 'analyst_b' end from events)
             select reader, event_id, {_stamp('ts')}, sha256('example' || user_id) as user_id, event_type, cast(null as double) as value, cast(null as varchar) as props from seen""",
        "top_vendors": _ALL
        + """, x as (select s.h, u from silver s join e on e.h = s.h where s.h % 4 <> 0),
                  v as (select h, 'vendor' || (u % 7) as vendor from x where h % 6 <> 1 union all select h, 'deep' || (u % 3) || ':co' from x where h % 5 <> 0)
             select vendor, count(*) as cve_count from v group by vendor order by cve_count desc, vendor limit 20""",
        "rule_cases": """with c as (select *, event_type || ':' || (props->>'$.k') as indicator from events where event_id % 20 = 0),
             t as (
               select 'R1' as rule_id, 'R1-' || event_id as "case", event_type = 'error' and value >= 50 as expected from c
               union all select 'R2', 'R2-' || event_id, value >= 100 from c
               union all select 'R3', 'R3-' || event_id, indicator = 'click:13' from c),
             kinds as (select r as rule_id, e as expected from unnest(['R1', 'R2', 'R3', 'R4']) a(r), unnest([true, false]) b(e))
             select *, expected as found, true as passed from t
             union all select rule_id, case when expected then 'no positive case' else 'no negative case' end, expected, null, false
             from kinds k where not exists (select 1 from t where t.rule_id = k.rule_id and t.expected = k.expected)""",
        "dq_rate_changes": """with d as (
               select cast(ts as date) as day, count(*) as records, count(*) filter (not coalesce(event_type <> 'error', false)) as no_error,
                      count(*) filter (not coalesce(value < 100, false)) as in_range, count(*) filter (props->>'$.k' is null) as keyed from events where ts is not null group by 1),
             r as (select day, 'no_error' as expectation, records, no_error as failed from d union all select day, 'in_range', records, in_range from d
                   union all select day, 'keyed', records, keyed from d),
             t as (select *, sum(failed) over w / sum(records) over w as trailing_rate
                   from r window w as (partition by expectation order by day range between interval 7 days preceding and interval 1 day preceding))
             select cast(day as varchar) as day, expectation, records, failed, failed / records as rate, trailing_rate, failed / records - trailing_rate as change from t""",
        "base_layout": _ALL + """select cast(8 as bigint) as buckets, cast(1 as bigint) as files_a_bucket, count(*) as "rows", cast(0 as bigint) as misplaced from silver""",
        "top_iocs_ranges": _EVENTS
        + """, d(a, b) as (values (date '2024-01-01', date '2024-01-31'), (date '2024-01-05', date '2024-01-11'), (date '2024-01-20', date '2024-01-20')),
             n as (select a, b, indicator, count(*) as sightings from c join d on cast(c."timestamp" as date) between a and b where indicator is not null group by all)
             select indicator, sightings, a || '..' || b as days from n qualify row_number() over (partition by a order by sightings desc, indicator) <= 10""",
        "triage_related": _then(_ALL, _EVENTS)
        + """, t as (select cve_id, list_distinct(regexp_extract_all(lower(coalesce(description_en, '')), '[a-z0-9]+')) as terms from silver),
             p as (select cve_id, unnest(terms) as term from t),
             w as (select term, (select count(*) from silver) // count(*) as weight from p group by term),
             r(rule_id, said) as (values ('R1', ['event', 'type', 'error', 'and', 'value', '50']), ('R2', ['value', '100']),
                                         ('R3', ['indicator', 'click', '13']), ('R4', ['value', '0'])),
             q as (select rule_id, unnest(said) as term from r),
             s as (select rule_id, cve_id, sum(weight)::bigint as score from q join p using (term) join w using (term) group by all),
             b as (select *, row_number() over (partition by rule_id order by score desc, cve_id) as place from s qualify place <= 3)
             select alert_id, cve_id, score, place from alerts join b using (rule_id)""",
    }
