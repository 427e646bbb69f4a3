"""DuckDB oracle SQL of the load flows, row by row: every target and the crosswalk of W1, W2 and W3."""

from __future__ import annotations

from .oracle import (
    CLEAN_PROJECTS,
    CLEAN_VERSIONS,
    IDENTS,
    INCREMENTAL_LOAD,
    RUN_TS,
    STAGED_PROJECTS,
    XW,
    ts,
    xw_ids,
    xw_max,
)
from .sources.fixtures import oracle

KNOWN_IDENTS = """
known_ids as (select l.chg_ref, string_agg(v.name, ', ' order by v.name) log_ident
  from fx_chg_vln_lnk l join fx_vulnerabilities v on l.vln_ref = v.id where v.name is not null group by l.chg_ref)
"""

FULL = f"""
k_proj as (select c.*, row_number() over (order by old_id) prj_id from ({CLEAN_PROJECTS}) c),
k_asm as (select a.id old_id, row_number() over (order by a.id) assm_id, coalesce({ts('nullif(a.time, 0)')}, {RUN_TS}) assm_date_created,
  coalesce(a.description, 'No description') assm_desc, p.prj_id, ' ' assm_version
  from fx_assemblies a join k_proj p on a.prj_ref = p.old_id),
k_src as (select id old_id, name pkg_name from fx_src_packages where name is not null),
k_pkg as (select pkg_name, row_number() over (order by min(old_id)) pkg_id from k_src group by pkg_name),
k_pkgmap as (select s.old_id, p.pkg_id from k_src s join k_pkg p on s.pkg_name = p.pkg_name),
{CLEAN_VERSIONS},
k_vin as (select cv.*, m.pkg_id from cv join k_pkgmap m on cv.src_pkg_ref = m.old_id),
k_first as (select pkg_id, version, min(old_id) first_old from k_vin group by pkg_id, version),
k_ver as (select f.*, row_number() over (order by first_old) pkg_vrs_id from k_first f),
k_vermap as (select v.old_id, n.pkg_vrs_id from k_vin v join k_ver n on v.pkg_id = n.pkg_id and v.version = n.version),
k_urg as (select name, row_number() over (order by min(id)) urg_id from fx_urgency where name is not null group by name),
k_vul as (select name, row_number() over (order by min(id)) id from fx_vulnerabilities where name is not null group by name),
k_chg as (select c.id old_id, row_number() over (order by c.id) id, coalesce(c.special, '') log_desc, m.pkg_vrs_id,
  coalesce({ts('v.time')}, {RUN_TS}) date_added
  from fx_changes c join k_vermap m on c.pkg_vsn_ref = m.old_id join fx_pkg_versions v on v.id = c.pkg_vsn_ref),
{IDENTS}
"""

PROJECT = "prj_id, prj_name, rel_id, prj_desc, vendor, arch_id"
ASSEMBLY = "assm_id, assm_date_created, assm_desc, prj_id, assm_version"

FULL_SELECTS = {
    "project": f"select {PROJECT} from k_proj",
    "assembly": f"select {ASSEMBLY} from k_asm",
    "package": "select pkg_id, pkg_name from k_pkg",
    "pkg_version": "select k.pkg_vrs_id, c.pkg_date_created, c.author_name, k.pkg_id, k.version from k_ver k join cv c on c.old_id = k.first_old",
    "urgency": "select urg_id, name urg_name from k_urg",
    "vulnerabilities": "select id, name from k_vul",
    "assm_pkg_vrs": "select distinct a.assm_id, v.pkg_vrs_id from fx_asm_pkg_vsn_lnk l join k_asm a on l.asm_ref = a.old_id "
    "join k_vermap v on l.pkg_vsn_ref = v.old_id",
    "changelog": "select k.id, k.log_desc, cast(null as bigint) urg_id, k.pkg_vrs_id, k.date_added, i.log_ident, "
    "cast(null as varchar) rep_name from k_chg k join ids i on i.chg_id = k.old_id",
    "crosswalk": "select 'projects' table_name, old_id, prj_id new_id from k_proj union all select 'assemblies', old_id, assm_id from k_asm "
    "union all select 'src_packages', old_id, pkg_id from k_pkgmap union all select 'pkg_versions', old_id, pkg_vrs_id from k_vermap "
    "union all select 'urgency', u.id, k.urg_id from fx_urgency u join k_urg k on u.name = k.name "
    "union all select 'vulnerabilities', v.id, k.id from fx_vulnerabilities v join k_vul k on v.name = k.name "
    "union all select 'changes', old_id, id from k_chg",
}

INCREMENTAL = f"""
{INCREMENTAL_LOAD.strip()},
n_proj as (select c.*, {xw_max('projects')} + row_number() over (order by old_id) prj_id from ({CLEAN_PROJECTS}) c
  where old_id not in {xw_ids('projects')}),
all_proj as (select old_id, new_id from {XW} where table_name = 'projects' union all select old_id, prj_id from n_proj),
n_asm as (select a.id old_id, k.new_id assm_id, coalesce({ts('nullif(a.time, 0)')}, {RUN_TS}) assm_date_created,
  coalesce(a.description, 'No description') assm_desc, p.new_id prj_id, ' ' assm_version
  from fx_assemblies a join i_asm_keys k on k.old_id = a.id join all_proj p on a.prj_ref = p.old_id),
n_urg as (select id old_id, name, {xw_max('urgency')} + row_number() over (order by id) urg_id from i_urg),
n_vul as (select id old_id, name, {xw_max('vulnerabilities')} + row_number() over (order by id) id from i_vul),
n_chg as (select c.id old_id, {xw_max('changes')} + row_number() over (order by c.id) id, coalesce(c.special, '') log_desc,
  m.new_id pkg_vrs_id, coalesce({ts('nullif(v.time, 0)')}, {RUN_TS}) date_added
  from fx_changes c join i_chg i on i.id = c.id join all_ver m on c.pkg_vsn_ref = m.old_id join fx_pkg_versions v on v.id = c.pkg_vsn_ref)
"""

INCREMENTAL_SELECTS = {
    "project": f"select {PROJECT} from n_proj",
    "assembly": f"select {ASSEMBLY} from n_asm",
    "package": "select pkg_id, pkg_name from numbered",
    "pkg_version": "select n.pkg_vrs_id, c.pkg_date_created, c.author_name, n.pkg_id, n.version from vnum n "
    "join vfresh f on f.pkg_id = n.pkg_id and f.version = n.version join cv c on c.old_id = f.first_old",
    "urgency": "select urg_id, name urg_name from n_urg",
    "vulnerabilities": "select id, name from n_vul",
    "assm_pkg_vrs": "select assm_id, pkg_vrs_id from i_links",
    "changelog": "select id, log_desc, cast(null as bigint) urg_id, pkg_vrs_id, date_added, '' log_ident, cast(null as varchar) rep_name from n_chg",
    "crosswalk": "select 'projects' table_name, old_id, prj_id new_id from n_proj union all select 'assemblies', old_id, assm_id from n_asm "
    "union all select 'src_packages', old_id, pkg_id from pkg_mapping union all select 'pkg_versions', old_id, pkg_vrs_id from ver_mapping "
    "union all select 'urgency', old_id, urg_id from n_urg union all select 'vulnerabilities', old_id, id from n_vul "
    "union all select 'changes', old_id, id from n_chg",
}

MAPPED = f"""
p_proj as (select id old_id, row_number() over (order by id) prj_id, name prj_name, rls_ref rel_id, description prj_desc, vendor, arc_ref arch_id
  from ({STAGED_PROJECTS}) sp),
p_asm as (select a.id old_id, row_number() over (order by a.id) assm_id, {ts('a.time')} assm_date_created, a.description assm_desc,
  p.prj_id, cast(null as varchar) assm_version from fx_assemblies a join p_proj p on a.prj_ref = p.old_id),
p_src as (select id old_id, name pkg_name from fx_src_packages where name is not null),
p_pkg as (select pkg_name, row_number() over (order by min(old_id)) pkg_id from p_src group by pkg_name),
p_pkgmap as (select s.old_id, p.pkg_id from p_src s join p_pkg p on s.pkg_name = p.pkg_name),
p_ver as (select v.id old_id, row_number() over (order by v.id) pkg_vrs_id, {ts('v.time')} pkg_date_created, v.maintainer author_name,
  m.pkg_id, v.version from fx_pkg_versions v join p_pkgmap m on v.src_pkg_ref = m.old_id),
p_chg as (select c.id old_id, row_number() over (order by c.id) id, c.special log_desc, m.pkg_vrs_id, {ts('nullif(v.time, 0)')} date_added
  from fx_changes c join p_ver m on c.pkg_vsn_ref = m.old_id left join fx_pkg_versions v on v.id = c.pkg_vsn_ref),
p_urg as (select id old_id, row_number() over (order by id) urg_id, name urg_name from fx_urgency),
{KNOWN_IDENTS}
"""

MAPPED_SELECTS = {
    "project": f"select {PROJECT} from p_proj",
    "assembly": f"select {ASSEMBLY} from p_asm",
    "package": "select pkg_id, pkg_name from p_pkg",
    "pkg_version": "select pkg_vrs_id, pkg_date_created, author_name, pkg_id, version from p_ver",
    "urgency": "select urg_id, urg_name from p_urg",
    "assm_pkg_vrs": "select a.assm_id, v.pkg_vrs_id from fx_asm_pkg_vsn_lnk l join p_asm a on l.asm_ref = a.old_id "
    "join p_ver v on l.pkg_vsn_ref = v.old_id",
    "changelog": "select p.id, p.log_desc, cast(null as bigint) urg_id, p.pkg_vrs_id, p.date_added, coalesce(k.log_ident, '') log_ident, "
    "cast(null as varchar) rep_name from p_chg p left join known_ids k on k.chg_ref = p.old_id",
    "crosswalk": "select 'project' table_name, old_id, prj_id new_id from p_proj union all select 'assembly', old_id, assm_id from p_asm "
    "union all select 'package', old_id, pkg_id from p_pkgmap union all select 'pkg_version', old_id, pkg_vrs_id from p_ver "
    "union all select 'changelog', old_id, id from p_chg union all select 'urgency', old_id, urg_id from p_urg",
}

PROJECTIONS = {
    "project": "select id prj_id, name prj_name, rls_ref rel_id, description prj_desc, vendor, arc_ref arch_id from "
    f"({STAGED_PROJECTS}) sp",
    "package": "select id pkg_id, name pkg_name from fx_src_packages",
    "pkg_version": f"select id pkg_vrs_id, {ts('time')} pkg_date_created, maintainer author_name, src_pkg_ref pkg_id, version from fx_pkg_versions",
    "assm_pkg_vrs": "select pkg_vsn_ref pkg_vrs_id, asm_ref assm_id from fx_asm_pkg_vsn_lnk",
    "changelog": f"select c.id, c.special log_desc, cast(null as bigint) urg_id, c.pkg_vsn_ref pkg_vrs_id, {ts('v.time')} date_added, "
    "k.log_ident, cast(null as varchar) rep_name from fx_changes c left join fx_pkg_versions v on v.id = c.pkg_vsn_ref "
    "left join known_ids k on k.chg_ref = c.id",
    "urgency": "select id urg_id, name urg_name from fx_urgency",
}

FLOW_ORACLE: dict[str, str] = {
    **{f"full_load_{t}": oracle(sql, FULL) for t, sql in FULL_SELECTS.items()},
    **{f"incremental_load_{t}": oracle(sql, INCREMENTAL) for t, sql in INCREMENTAL_SELECTS.items()},
    **{f"mapped_load_{t}": oracle(sql, MAPPED) for t, sql in MAPPED_SELECTS.items()},
    **{f"mapped_projection_{t}": oracle(sql, KNOWN_IDENTS) for t, sql in PROJECTIONS.items()},
}
