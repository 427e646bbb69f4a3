"""DuckDB oracle SQL, one statement per registered job.

Each statement starts with the fixture views (``FIXTURE_CTES``) and is run by
the checker on the driver's own tables.  Column names equal the Spark job's.
"""

from __future__ import annotations

from .sources.fixtures import oracle

CVE = "'CVE-[0-9]{4}-[0-9]{4,7}'"
RUN_TS = "TIMESTAMP '2025-02-11 00:00:00'"

# Shared CTE blocks.
SCOPE = """
scope as (select pkg_vrs_id, pkg_name, version from fx_repo_pkg_version where pkg_vrs_id in (select l_partkey from lineitem)),
chg as (select c.id, c.pkg_vsn_ref pkg_vrs_id, c.special from fx_changes c where c.pkg_vsn_ref in (select l_partkey from lineitem)),
vul as (select name, max(id) vid from fx_vulnerabilities where name is not null group by name),
vkey as (select pkg_name, version, max(pkg_vrs_id) pkg_vrs_id from scope where pkg_name is not null and pkg_name <> '' group by pkg_name, version)
"""

MENTIONS = f"""
mentions as (select distinct chg_id, pkg_vrs_id, cve from (select id chg_id, pkg_vsn_ref pkg_vrs_id, unnest(regexp_extract_all(special, {CVE})) cve from fx_changes) m)
"""

TRACKER_FIXES = """
trk_fix as (select distinct k.pkg_vrs_id, v.vid from fx_trk_cve dc join fx_trk_cve_rep cr on dc.cve_id=cr.cve_id
  join fx_trk_pkg_version pv on pv.pkg_vrs_id=cr.fixed_pkg_vrs_id join fx_trk_package p on p.pkg_id=pv.pkg_id
  join vkey k on k.pkg_name=p.pkg_name and k.version is not distinct from pv.version
  join vul v on v.name=dc.cve_name)
"""

FLAGSHIP_CTES = (
    SCOPE
    + ","
    + TRACKER_FIXES
    + f""",
first_chg as (select pkg_vrs_id, min(id) mid from chg group by pkg_vrs_id),
hit as (select id, pkg_vrs_id, unnest(list_distinct(regexp_extract_all(special, {CVE}))) cve from chg),
ev1 as (select h.pkg_vrs_id, v.vid, min(h.id) chg_no from hit h join vul v on h.cve = v.name group by 1, 2),
ev2 as (select t.pkg_vrs_id, t.vid, f.mid trk_no from trk_fix t left join first_chg f on f.pkg_vrs_id = t.pkg_vrs_id)
"""
)

FLAGSHIP_SELECT = """
select coalesce(a.pkg_vrs_id, b.pkg_vrs_id) pkg_vrs_id, coalesce(a.vid, b.vid) vulnerability_id,
  a.chg_no changelog_string_number, b.trk_no fixed_tracker_string_number
from ev1 a full outer join ev2 b on a.pkg_vrs_id = b.pkg_vrs_id and a.vid = b.vid
"""


def ts(x: str) -> str:
    """Epoch seconds to a zone-less UTC timestamp (NULL stays NULL)."""
    return f"make_timestamp(cast({x} as bigint) * 1000000)"


STAGED_PROJECTS = "select p.*, b.name vendor from fx_projects p join fx_publishers b on p.pbr_ref = b.id"
XW = "fx_id_mappings"


def xw_ids(table: str) -> str:
    return f"(select old_id from {XW} where table_name = '{table}')"


def xw_max(table: str) -> str:
    return f"coalesce((select max(new_id) from {XW} where table_name = '{table}'), 0)"


CLEAN_PROJECTS = f"""
select id old_id, coalesce(name, 'unknown') prj_name, nullif(rls_ref, 0) rel_id, description prj_desc,
  coalesce(vendor, 'unknown') vendor, nullif(arc_ref, 0) arch_id from ({STAGED_PROJECTS}) sp
"""

CLEAN_VERSIONS = f"""
cv as (select id old_id, coalesce({ts('nullif(time, 0)')}, {RUN_TS}) pkg_date_created, nullif(maintainer, '') author_name,
  src_pkg_ref, coalesce(nullif(version, ''), '0.0.0') version from fx_pkg_versions)
"""

def packages_ctes(base: str = "coalesce((select max(pkg_id) from ex), 0)") -> str:
    return f"""
ex as (select m.new_id pkg_id, s.name pkg_name from {XW} m join fx_src_packages s on m.old_id = s.id
  where m.table_name = 'src_packages' and s.name is not null),
known as (select pkg_name, min(pkg_id) pkg_id from ex group by pkg_name),
todo as (select id old_id, name pkg_name from fx_src_packages where name is not null and id not in {xw_ids('src_packages')}),
fresh as (select pkg_name, min(old_id) first_old from todo where pkg_name not in (select pkg_name from known) group by pkg_name),
numbered as (select pkg_name, {base} + row_number() over (order by first_old) pkg_id from fresh),
keyed as (select pkg_name, pkg_id from known union all select pkg_name, pkg_id from numbered),
pkg_mapping as (select t.old_id, t.pkg_name, k.pkg_id from todo t join keyed k on t.pkg_name = k.pkg_name)
"""


PACKAGES = packages_ctes()

def versions_ctes(base: str = "coalesce((select max(pkg_vrs_id) from exv), 0)") -> str:
    return f"""
pkgmap as (select old_id, new_id pkg_id from {XW} where table_name = 'src_packages' union all select old_id, pkg_id from pkg_mapping),
exv as (select mv.new_id pkg_vrs_id, ms.new_id pkg_id, cv.version from cv
  join {XW} mv on mv.table_name = 'pkg_versions' and mv.old_id = cv.old_id
  join {XW} ms on ms.table_name = 'src_packages' and ms.old_id = cv.src_pkg_ref),
vknown as (select pkg_id, version, min(pkg_vrs_id) pkg_vrs_id from exv group by pkg_id, version),
vtodo as (select cv.old_id, pm.pkg_id, cv.version from cv join pkgmap pm on cv.src_pkg_ref = pm.old_id
  where cv.old_id not in {xw_ids('pkg_versions')}),
vfresh as (select pkg_id, version, min(old_id) first_old from vtodo t
  where not exists (select 1 from vknown k where k.pkg_id = t.pkg_id and k.version = t.version) group by pkg_id, version),
vnum as (select pkg_id, version, {base} + row_number() over (order by first_old) pkg_vrs_id from vfresh),
vkeyed as (select pkg_id, version, pkg_vrs_id from vknown union all select pkg_id, version, pkg_vrs_id from vnum),
ver_mapping as (select t.old_id, t.pkg_id, t.version, k.pkg_vrs_id from vtodo t join vkeyed k on t.pkg_id = k.pkg_id and t.version = k.version)
"""


VERSIONS = versions_ctes()

LINKS_LEFT = f"""
fx_asm_pkg_vsn_lnk l left join {XW} ma on ma.table_name = 'assemblies' and l.asm_ref = ma.old_id
  left join {XW} mp on mp.table_name = 'pkg_versions' and l.pkg_vsn_ref = mp.old_id
"""

REMAPPED_LINKS = f"""
rl as (select ma.new_id assm_id, mp.new_id pkg_vrs_id from fx_asm_pkg_vsn_lnk l
  join {XW} ma on ma.table_name = 'assemblies' and l.asm_ref = ma.old_id
  join {XW} mp on mp.table_name = 'pkg_versions' and l.pkg_vsn_ref = mp.old_id)
"""

IDENTS = """
ids as (select c.id chg_id, coalesce(string_agg(v.name, ', ' order by v.name), '') log_ident from fx_changes c
  left join fx_chg_vln_lnk l on c.id = l.chg_ref left join fx_vulnerabilities v on l.vln_ref = v.id group by c.id)
"""


def changelog_rows(zero_is_null: bool, with_idents: bool, only_new: bool) -> str:
    t = ts("nullif(v.time, 0)") if zero_is_null else ts("v.time")
    ident = "i.log_ident" if with_idents else "''"
    join_ids = "join ids i on i.chg_id = c.id" if with_idents else ""
    where = f"where c.id not in {xw_ids('changes')}" if only_new else ""
    return f"""
rows as (select c.id old_id, coalesce(c.special, '') log_desc, cast(null as bigint) urg_id, m.new_id pkg_vrs_id,
  coalesce({t}, {RUN_TS}) date_added, cast(null as varchar) rep_name, {ident} log_ident from fx_changes c
  join {XW} m on m.table_name = 'pkg_versions' and c.pkg_vsn_ref = m.old_id
  join fx_pkg_versions v on c.pkg_vsn_ref = v.id {join_ids} {where})
"""


FULL_LOAD = """
f_proj as (select p.id from fx_projects p join fx_publishers b on p.pbr_ref = b.id),
f_asm as (select id from fx_assemblies where prj_ref in (select id from f_proj)),
f_src as (select id, name from fx_src_packages where name is not null),
f_ver as (select v.id, s.name, coalesce(nullif(v.version, ''), '0.0.0') version from fx_pkg_versions v join f_src s on v.src_pkg_ref = s.id),
f_link as (select distinct l.asm_ref, v.name, v.version from fx_asm_pkg_vsn_lnk l join f_ver v on l.pkg_vsn_ref = v.id
  where l.asm_ref in (select id from f_asm)),
f_chg as (select id from fx_changes where pkg_vsn_ref in (select id from f_ver))
"""

FULL_LOAD_SELECT = """
select 'project' table_name, count(*) n_rows from f_proj
union all select 'assembly', count(*) from f_asm
union all select 'package', count(distinct name) from f_src
union all select 'pkg_version', count(*) from (select distinct name, version from f_ver) t
union all select 'urgency', count(distinct name) from fx_urgency where name is not null
union all select 'vulnerabilities', count(distinct name) from fx_vulnerabilities where name is not null
union all select 'assm_pkg_vrs', count(*) from f_link
union all select 'changelog', count(*) from f_chg
union all select 'id_mappings', (select count(*) from f_proj) + (select count(*) from f_asm) + (select count(*) from f_src)
  + (select count(*) from f_ver) + (select count(*) from fx_urgency where name is not null)
  + (select count(*) from fx_vulnerabilities where name is not null) + (select count(*) from f_chg)
"""

INCREMENTAL_LOAD = f"""
i_staged as (select p.id from fx_projects p join fx_publishers b on p.pbr_ref = b.id),
i_proj as (select id from i_staged where id not in {xw_ids('projects')}),
i_asm as (select a.id from fx_assemblies a where a.id not in {xw_ids('assemblies')}
  and (a.prj_ref in {xw_ids('projects')} or a.prj_ref in (select id from i_proj))),
i_asm_keys as (select id old_id, {xw_max('assemblies')} + row_number() over (order by id) new_id from i_asm),
{packages_ctes(f"greatest(coalesce((select max(pkg_id) from ex), 0), {xw_max('src_packages')})")},
{CLEAN_VERSIONS},
{versions_ctes(f"greatest(coalesce((select max(pkg_vrs_id) from exv), 0), {xw_max('pkg_versions')})")},
i_urg as (select id, name from fx_urgency where name is not null and id not in {xw_ids('urgency')}),
i_vul as (select id, name from fx_vulnerabilities where name is not null and id not in {xw_ids('vulnerabilities')}),
all_asm as (select old_id, new_id from {XW} where table_name = 'assemblies' union all select old_id, new_id from i_asm_keys),
all_ver as (select old_id, new_id from {XW} where table_name = 'pkg_versions' union all select old_id, pkg_vrs_id from ver_mapping),
ex_pairs as (select distinct ma.new_id assm_id, mp.new_id pkg_vrs_id from fx_asm_pkg_vsn_lnk l
  join {XW} ma on ma.table_name = 'assemblies' and l.asm_ref = ma.old_id
  join {XW} mp on mp.table_name = 'pkg_versions' and l.pkg_vsn_ref = mp.old_id),
new_pairs as (select distinct a.new_id assm_id, v.new_id pkg_vrs_id from fx_asm_pkg_vsn_lnk l
  join all_asm a on l.asm_ref = a.old_id join all_ver v on l.pkg_vsn_ref = v.old_id),
i_links as (select * from new_pairs n where not exists (select 1 from ex_pairs e where e.assm_id = n.assm_id and e.pkg_vrs_id = n.pkg_vrs_id)),
i_chg as (select c.id from fx_changes c where c.id not in {xw_ids('changes')}
  and c.pkg_vsn_ref in (select old_id from all_ver) and c.pkg_vsn_ref in (select id from fx_pkg_versions))
"""

INCREMENTAL_LOAD_SELECT = """
select 'project' table_name, count(*) n_rows from i_proj
union all select 'assembly', count(*) from i_asm
union all select 'package', count(*) from fresh
union all select 'pkg_version', count(*) from vfresh
union all select 'urgency', count(*) from i_urg
union all select 'vulnerabilities', count(*) from i_vul
union all select 'assm_pkg_vrs', count(*) from i_links
union all select 'changelog', count(*) from i_chg
union all select 'id_mappings', (select count(*) from i_proj) + (select count(*) from i_asm) + (select count(*) from pkg_mapping)
  + (select count(*) from ver_mapping) + (select count(*) from i_urg) + (select count(*) from i_vul) + (select count(*) from i_chg)
"""

MAPPED_LOAD = """
m_proj as (select p.id from fx_projects p join fx_publishers b on p.pbr_ref = b.id),
m_asm as (select id from fx_assemblies where prj_ref in (select id from m_proj)),
m_src as (select id, name from fx_src_packages where name is not null),
m_ver as (select id from fx_pkg_versions where src_pkg_ref in (select id from m_src)),
m_link as (select * from fx_asm_pkg_vsn_lnk where asm_ref in (select id from m_asm) and pkg_vsn_ref in (select id from m_ver)),
m_chg as (select id from fx_changes where pkg_vsn_ref in (select id from m_ver)),
m_cve as (select id from fx_vulnerabilities where name is not null)
"""

MAPPED_LOAD_SELECT = """
select 'project' table_name, count(*) n_rows from m_proj
union all select 'assembly', count(*) from m_asm
union all select 'package', count(distinct name) from m_src
union all select 'pkg_version', count(*) from m_ver
union all select 'assm_pkg_vrs', count(*) from m_link
union all select 'changelog', count(*) from m_chg
union all select 'urgency', count(*) from fx_urgency
union all select 'id_mappings', (select count(*) from m_proj) + (select count(*) from m_asm) + (select count(*) from m_src)
  + (select count(*) from m_ver) + (select count(*) from m_chg) + (select count(*) from fx_urgency)
union all select 'reject:projects_without_publisher', count(*) from fx_projects p
  where not exists (select 1 from fx_publishers b where b.id = p.pbr_ref)
union all select 'reject:assemblies_without_project', count(*) from fx_assemblies where id not in (select id from m_asm)
union all select 'reject:versions_without_package', count(*) from fx_pkg_versions where id not in (select id from m_ver)
union all select 'reject:links_with_unmapped_end', (select count(*) from fx_asm_pkg_vsn_lnk) - (select count(*) from m_link)
union all select 'reject:changes_without_version', count(*) from fx_changes where id not in (select id from m_chg)
union all select 'reject:change_links_unmapped', count(*) from fx_chg_vln_lnk
  where chg_ref not in (select id from m_chg) or vln_ref not in (select id from m_cve)
"""

SOURCE_FIXTURES = ("publishers", "projects", "assemblies", "src_packages", "pkg_versions", "asm_pkg_vsn_lnk",
                   "changes", "urgency", "vulnerabilities", "chg_vln_lnk")

ORACLE: dict[str, str] = {
    # --- step 2: CVE evidence ------------------------------------------------
    "cve_mentions": oracle("select chg_id, pkg_vrs_id, cve from mentions", MENTIONS),
    "cve_unknown_mentions": oracle(
        "select chg_id, cve from mentions where cve not in (select name from fx_vulnerabilities where name is not null) "
        "and pkg_vrs_id in (select l_partkey from lineitem)",
        MENTIONS,
    ),
    "first_change_per_version": oracle(
        "select pkg_vrs_id, min(id) first_chg_id from chg group by pkg_vrs_id", SCOPE
    ),
    "repo_version_key": oracle("select pkg_name, version, pkg_vrs_id from vkey", SCOPE),
    "tracker_fixes": oracle(
        "select pkg_vrs_id, vid vulnerability_id from trk_fix", SCOPE + "," + TRACKER_FIXES
    ),
    "tracker_unknown_cves": oracle(
        """select distinct dc.cve_name, k.pkg_vrs_id from fx_trk_cve dc join fx_trk_cve_rep cr on dc.cve_id = cr.cve_id
join fx_trk_pkg_version pv on pv.pkg_vrs_id = cr.fixed_pkg_vrs_id join fx_trk_package p on p.pkg_id = pv.pkg_id
join vkey k on k.pkg_name = p.pkg_name and k.version is not distinct from pv.version
where not exists (select 1 from vul v where v.name = dc.cve_name)""",
        SCOPE,
    ),
    "changes_in_scope": oracle("select count(*) n_changes from chg", SCOPE),
    "cve_fix_status": oracle(FLAGSHIP_SELECT, FLAGSHIP_CTES),
    # --- step 3: staging and cleaning --------------------------------------------
    "projects_with_vendor": oracle(
        "select id old_id, name, rls_ref, description, vendor, arc_ref from sp", f"sp as ({STAGED_PROJECTS})"
    ),
    "mapped_projection": oracle(
        f"select id assm_id, {ts('time')} assm_date_created, description assm_desc, prj_ref prj_id, "
        "cast(null as varchar) assm_version from fx_assemblies"
    ),
    "clean_projects": oracle(CLEAN_PROJECTS),
    "clean_assemblies": oracle(
        f"select id old_id, coalesce({ts('nullif(time, 0)')}, {RUN_TS}) assm_date_created, "
        "coalesce(description, 'No description') assm_desc, prj_ref, ' ' assm_version from fx_assemblies"
    ),
    "clean_pkg_versions": oracle("select * from cv", CLEAN_VERSIONS),
    "epoch_zero_as_null": oracle(f"select id old_id, {ts('nullif(time, 0)')} pkg_date_created from fx_pkg_versions"),
    "epoch_zero_as_1970": oracle(f"select id old_id, coalesce({ts('time')}, {RUN_TS}) assm_date_created from fx_assemblies"),
    "time_missing_sample": oracle(
        "select id old_id, time from fx_assemblies where time = 0 or time is null order by id limit 5"
    ),
    # --- step 4: crosswalk ---------------------------------------------------------
    "delta_projects": oracle(f"select * from ({CLEAN_PROJECTS}) c where old_id not in {xw_ids('projects')}"),
    "new_keys_assemblies": oracle(
        f"""select a.id old_id, {xw_max('assemblies')} + row_number() over (order by a.id) new_id
from fx_assemblies a join {XW} m on m.table_name = 'projects' and a.prj_ref = m.old_id
where a.id not in {xw_ids('assemblies')}"""
    ),
    "remap_assemblies": oracle(
        f"select a.id old_id, a.prj_ref, m.new_id prj_id from fx_assemblies a join {XW} m "
        "on m.table_name = 'projects' and a.prj_ref = m.old_id"
    ),
    "crosswalk_merge": oracle(
        f"""select table_name, old_id, new_id from {XW}
union all select n.table_name, n.old_id, n.new_id from newkeys n
where not exists (select 1 from {XW} m where m.table_name = n.table_name and m.old_id = n.old_id)""",
        f"""
newp as (select 'projects' table_name, old_id, {xw_max('projects')} + row_number() over (order by old_id) new_id
  from ({CLEAN_PROJECTS}) c where old_id not in {xw_ids('projects')}),
newa as (select 'assemblies' table_name, a.id old_id, {xw_max('assemblies')} + row_number() over (order by a.id) new_id
  from fx_assemblies a join {XW} m on m.table_name = 'projects' and a.prj_ref = m.old_id),
newkeys as (select * from newp union all select * from newa)
""",
    ),
    "crosswalk_sizes": oracle(f"select table_name, count(*) n_mappings from {XW} group by table_name"),
    "crosswalk_from_targets": oracle(
        f"""select 'project' table_name, new_id old_id, new_id from {XW} where table_name = 'projects'
union all select 'assembly', new_id, new_id from {XW} where table_name = 'assemblies'
union all select 'package', pkg_id, pkg_id from ex
union all select 'pkg_version', pkg_vrs_id, pkg_vrs_id from exv
union all select 'changelog', id, id from fx_changes
union all select 'urgency', id, id from fx_urgency""",
        PACKAGES + "," + CLEAN_VERSIONS + "," + VERSIONS,
    ),
    "crosswalk_round_trip": oracle(f"select table_name, old_id, new_id from {XW}"),
    # --- step 5: natural keys -------------------------------------------------------
    "package_get_or_create": oracle("select old_id, pkg_name, pkg_id from pkg_mapping", PACKAGES),
    "version_get_or_create": oracle(
        "select old_id, pkg_id, version, pkg_vrs_id from ver_mapping", PACKAGES + "," + CLEAN_VERSIONS + "," + VERSIONS
    ),
    "distinct_names": oracle(
        "select name, row_number() over (order by first_old) id, n_old_ids from "
        "(select name, min(id) first_old, count(*) n_old_ids from fx_vulnerabilities where name is not null group by name) t"
    ),
    # --- step 6: links ----------------------------------------------------------------
    "link_remap": oracle("select assm_id, pkg_vrs_id from rl", REMAPPED_LINKS),
    "link_remap_new_only": oracle(
        "select distinct assm_id, pkg_vrs_id from rl where not exists (select 1 from rl e where e.assm_id % 3 = 0 "
        "and e.assm_id = rl.assm_id and e.pkg_vrs_id = rl.pkg_vrs_id)",
        REMAPPED_LINKS,
    ),
    # --- step 7: changelog --------------------------------------------------------------
    "changelog_idents": oracle("select chg_id, log_ident from ids", IDENTS),
    "changelog_idents_known_only": oracle(
        "select c.id chg_id, coalesce(k.log_ident, '') log_ident, coalesce(k.n_known, 0) n_known "
        "from fx_changes c left join k on c.id = k.chg_ref",
        "k as (select l.chg_ref, string_agg(v.name, ', ' order by v.name) log_ident, count(*) n_known "
        "from fx_chg_vln_lnk l join fx_vulnerabilities v on l.vln_ref = v.id where v.name is not null group by l.chg_ref)",
    ),
    "changelog_full": oracle(
        "select *, row_number() over (order by old_id) id from rows",
        IDENTS + "," + changelog_rows(zero_is_null=False, with_idents=True, only_new=False),
    ),
    "changelog_delta": oracle(
        f"select *, {xw_max('changes')} + row_number() over (order by old_id) id from rows",
        changelog_rows(zero_is_null=True, with_idents=False, only_new=True),
    ),
    # --- step 8: audits -------------------------------------------------------------------
    "row_counts": oracle(
        " union all ".join(f"select '{t}' table_name, count(*) n_rows from fx_{t}" for t in SOURCE_FIXTURES)
    ),
    "orphan_refs": oracle(
        f"""select 'assemblies.prj_ref' check_name, count(distinct prj_ref) distinct_refs, count(*) n_rows from fx_assemblies
  where prj_ref not in (select id from ({STAGED_PROJECTS}) sp)
union all
select 'pkg_versions.src_pkg_ref', count(distinct src_pkg_ref), count(*) from fx_pkg_versions
  where src_pkg_ref not in (select id from fx_src_packages)"""
    ),
    "link_audit": oracle(
        "select count(*) total_links, count(*) filter (where ma.new_id is null) missing_assemblies, "
        f"count(*) filter (where mp.new_id is null) missing_versions from {LINKS_LEFT}"
    ),
    "link_audit_sample": oracle(
        "select l.asm_ref, l.pkg_vsn_ref, ma.new_id mapped_asm_id, mp.new_id mapped_pkg_id from "
        f"{LINKS_LEFT} where ma.new_id is null or mp.new_id is null order by l.asm_ref, l.pkg_vsn_ref limit 10"
    ),
    "assembly_sample": oracle("select id old_id, prj_ref, time from fx_assemblies order by id limit 10"),
    "rejected_versions": oracle(
        f"""select v.id old_id, v.src_pkg_ref from fx_pkg_versions v where v.id not in {xw_ids('pkg_versions')}
and not exists (select 1 from {XW} m where m.table_name = 'src_packages' and m.old_id = v.src_pkg_ref)"""
    ),
    "rejected_change_links": oracle(
        """select l.chg_ref, l.vln_ref, cm.id is not null change_mapped, vm.id is not null cve_mapped
from fx_chg_vln_lnk l left join chmap cm on cm.id = l.chg_ref left join vmap vm on vm.id = l.vln_ref
where cm.id is null or vm.id is null""",
        f"""chmap as (select id from fx_changes where pkg_vsn_ref in {xw_ids('pkg_versions')}),
vmap as (select id from fx_vulnerabilities where name is not null)""",
    ),
    # --- step 9: merge into the fix-status table -----------------------------------------
    "cve_fix_upsert": oracle(
        """select coalesce(e.pkg_vrs_id, s.pkg_vrs_id) pkg_vrs_id, coalesce(e.vulnerability_id, s.vulnerability_id) vulnerability_id,
  coalesce(e.changelog_string_number, s.changelog_string_number) changelog_string_number,
  coalesce(e.fixed_tracker_string_number, s.fixed_tracker_string_number) fixed_tracker_string_number,
  case when e.pkg_vrs_id is not null then e.manual_input_user_id end manual_input_user_id
from existing e full outer join status s on e.pkg_vrs_id = s.pkg_vrs_id and e.vulnerability_id = s.vulnerability_id""",
        FLAGSHIP_CTES
        + f""",
status as ({FLAGSHIP_SELECT}),
existing as (select pkg_vrs_id, vulnerability_id,
  case when vulnerability_id % 2 = 0 then null else changelog_string_number end changelog_string_number,
  coalesce(fixed_tracker_string_number, -1) fixed_tracker_string_number, cast(1 as bigint) manual_input_user_id
  from status where pkg_vrs_id % 3 = 0)
""",
    ),
    # --- step 10: whole flows -----------------------------------------------------------------
    "full_load_counts": oracle(FULL_LOAD_SELECT, FULL_LOAD),
    "incremental_load_counts": oracle(INCREMENTAL_LOAD_SELECT, INCREMENTAL_LOAD),
    "mapped_load_counts": oracle(MAPPED_LOAD_SELECT, MAPPED_LOAD),
    "integrity_report": oracle(
        f"""select 'assemblies' check_name, count(*) value from fx_assemblies
union all select 'assemblies_time_missing', count(*) filter (where time = 0 or time is null) from fx_assemblies
union all select 'pkg_versions', count(*) from fx_pkg_versions
union all select 'assemblies_missing_project_refs', count(distinct prj_ref) from fx_assemblies where prj_ref not in (select id from ({STAGED_PROJECTS}) sp)
union all select 'assemblies_missing_project_rows', count(*) from fx_assemblies where prj_ref not in (select id from ({STAGED_PROJECTS}) sp)
union all select 'versions_missing_package_refs', count(distinct src_pkg_ref) from fx_pkg_versions where src_pkg_ref not in (select id from fx_src_packages)
union all select 'versions_missing_package_rows', count(*) from fx_pkg_versions where src_pkg_ref not in (select id from fx_src_packages)
union all select 'total_links', count(*) from {LINKS_LEFT}
union all select 'links_missing_assembly', count(*) filter (where ma.new_id is null) from {LINKS_LEFT}
union all select 'links_missing_version', count(*) filter (where mp.new_id is null) from {LINKS_LEFT}"""
    ),
}
