"""SQL that states the expected result of each registered query over the same tables."""

from __future__ import annotations

from shelfmark import fixed

VIEWS = {
    "subs": """
      select o_orderkey as source_key, o_custkey as owner,
        'ds_' || cast(o_custkey as varchar) as source_name, o_orderdate as submission_time,
        o_orderstatus = 'P' as active, o_orderkey % 10 = 0 as test,
        case o_orderstatus when 'F' then 'SSF' when 'P' then 'SPz' else
          case o_orderkey % 5 when 0 then 'SSX' when 1 then 'zzz' when 2 then 'SRS'
            when 3 then 'SRM' else 'MMM' end end as status_code,
        case when o_orderkey % 7 = 0 then null else o_orderpriority end as organization,
        o_totalprice as size_mb
      from orders""",
    "numbered": """
      select *, row_number() over (
        partition by source_name order by submission_time, source_key) as version from subs""",
    "catalog": """
      select *, source_name || '_v' || cast(version as varchar) || '.1' as source_id
      from numbered""",
    "worded": """
      select *, case when status_code like '%F%' then 'Failed'
        when status_code like '%P%' then 'Processing'
        when right(status_code, 1) = 'S' then 'Succeeded'
        when right(status_code, 1) = 'X' then 'Cancelled'
        when left(status_code, 1) = 'z' then 'Not started'
        when status_code like '%R%' then 'Retrying error' else 'Unknown' end as word
      from catalog""",
    "routed": """
      select *, case when test then '_test_' else '' end || source_id as routed_id from catalog""",
    "edit_log": """
      select user_id as submission_id, row_number() over (
          partition by user_id order by ts, event_id) as seq,
        case event_type when 'view' then 'append' when 'click' then 'upsert'
          when 'purchase' then 'delete' when 'signup' then 'set' else 'clear' end as op,
        'k' || cast(event_id % 5 as varchar) as key, props as payload, event_id, value
      from events""",
    "calls": """
      select user_id as submission_id, event_id as seq,
        case event_type when 'view' then 'append' when 'click' then 'upsert'
          when 'purchase' then 'upsert' when 'signup' then 'set'
          else case when event_id % 3 = 2 then 'reset' else 'clear' end end as op,
        case event_type when 'view' then 'tags' when 'click' then 'services'
          when 'purchase' then 'projects' when 'signup' then 'organization'
          else case event_id % 3 when 0 then 'tags' when 1 then 'services' end end as field,
        case when event_type in ('click', 'purchase') then 'k' || cast(event_id % 5 as varchar)
          end as key,
        case event_type when 'view' then 't' || cast(event_id % 100 as varchar)
          when 'click' then case when value < 3 then 'true' when value < 6 then 'false'
            else props end
          when 'purchase' then case when value < 3 then 'null' else props end
          when 'signup' then '"org ' || cast(event_id % 5 as varchar) || '"' end as payload
      from events""",
    "live_calls": """
      select c.* from calls c
        left join (select submission_id, field, max(seq) as last from calls
          where op = 'clear' group by 1, 2) f using (submission_id, field)
        left join (select submission_id, max(seq) as reset from calls
          where op = 'reset' group by 1) r using (submission_id)
      where op not in ('clear', 'reset') and seq > coalesce(last, -1)
        and seq > coalesce(reset, -1)""",
    "cleared": """
      select e.* from edit_log e left join (
        select submission_id, key, max(seq) as last from edit_log where op = 'clear' group by 1, 2
      ) c using (submission_id, key)
      where op <> 'clear' and (last is null or seq > last)""",
    "unsafe": """
      select * exclude (payload), case event_id % 7 when 0 then '{"k": NaN}'
        when 1 then '{"k": 1e400}' when 2 then '{"k": ' when 3 then '{"k": "Infinity"}'
        else payload end as payload, event_id % 7 < 3 as bad from edit_log""",
    "dc_input": """
      select p_partkey as submission_id,
        case when p_partkey % 50 = 0 then '' else p_name end as title, p_name,
        split_part(p_name, ' ', 1) as w1, split_part(p_name, ' ', 2) as w2,
        p_type as subject1, p_brand as tag1, p_size as size,
        case when p_size % 4 <> 0 then 'Org ' || cast(p_size as varchar) end as aff1,
        case when p_size % 4 >= 2 then 'Lab ' || p_type end as aff2,
        case when p_partkey % 3 = 1 then cast(1990 + p_size as varchar) else '2024' end as year,
        case when p_partkey % 4 = 0 then '10.5555/' || cast(p_partkey as varchar) end as doi,
        case when p_size % 2 = 1 then p_brand else 'Open Dataset Catalog' end as publisher
      from part""",
    "authors_raw": """
      select submission_id, 1 as ord, w2 as family, w1 as given from dc_input where size % 10 <> 0
      union all
      select submission_id, 2, subject1, tag1 from dc_input where size % 3 <> 0
      union all
      select submission_id, 3,
        case submission_id % 6 when 4 then 'van ' || w2 when 5 then w2 || ' Jr.' else w2 end, w1
      from dc_input where size % 10 <> 0""",
    "authors": """
      select submission_id,
        cast(row_number() over (partition by submission_id order by ord) - 1 as integer) as pos,
        cast(count(*) over (partition by submission_id) as integer) as n,
        family || ', ' || given as creator_name, family, given from authors_raw""",
    "affs": """
      select submission_id, 0 as pos, aff1 as affiliation,
        case when aff2 is null then 1 else 2 end as n from dc_input where aff1 is not null
      union all select submission_id, 1, aff2, 2 from dc_input where aff2 is not null""",
    "author_affs": """
      select a.submission_id, a.pos as author_pos,
        case when a.n = f.n then 0 else f.pos end as pos, f.affiliation
      from authors a join affs f on a.submission_id = f.submission_id
        and (a.n <> f.n or a.pos = f.pos)""",
    "acl_input": """
      select c_custkey as source_key,
        case when c_nationkey % 4 = 0 then 'public' else 'nation_' || cast(c_nationkey as varchar)
          end as base, case when c_custkey % 3 = 0 then 'seg_' || c_mktsegment end as extra
      from customer""",
    "principals": """
      select 'nation_' || cast(n_nationkey as varchar) as principal from nation
      where n_regionkey = 1 union select 'seg_BUILDING' union select 'public'""",
    "tasks": """
      select source_id, owner as submitter,
        strftime(submission_time, '%Y-%m-%dT%H:%M:%SZ') as waiting_since,
        'Extracted ' || cast(version as varchar) || ' records' as extraction_summary,
        organization, source_key from catalog where active""",
    "verdicts": """
      select case when source_key % 11 = 0 then source_id || '_gone' else source_id end
          as source_id,
        case source_key % 4 when 0 then 'accept' when 1 then 'reject' when 2 then 'accept'
          else 'maybe' end as action,
        case source_key % 3 when 0 then ' ' when 1 then 'because' end as reason, source_key
      from tasks""",
    "updates": """
      select source_id, owner + source_key % 2 as requester, case when source_key % 3 <> 0
        then 'new title ' || cast(source_key as varchar) end as title from catalog""",
    "incoming": """
      select c_custkey as incoming_key, case when c_nationkey % 5 = 0 then 'new_' else 'ds_' end
          || cast(c_custkey as varchar) as source_name, c_custkey % 3 = 0 as "update",
        case when c_custkey % 2 = 0 then 'org ' || c_mktsegment end as organization,
        case when c_custkey % 4 = 0 then c_acctbal end as size_mb from customer""",
    "locations": """
      select page_id, url from pages
      union all select 1000000 + n_nationkey,
        'https://www.globus.org/app/transfer?origin_id=ep' || cast(n_nationkey as varchar)
          || '&origin_path=%2Fdata%2F' || n_name || '%2F' from nation
      union all select 2000000 + r_regionkey,
        'globus://ep' || cast(r_regionkey as varchar) || '/data/' from region
      union all select 3000000 + r_regionkey, 'googledrive:///' || r_name || '.zip' from region""",
    "located": """
      select l.page_id, url, case when n_nationkey is null then url
        else 'globus://ep' || cast(n_nationkey as varchar) || '/data/' || n_name || '/' end
          as location
      from locations l left join nation on page_id = 1000000 + n_nationkey""",
    "page_fields": """
      select page_id, url, nullif(regexp_extract(name, '^([0-9]+)', 1), '') as number,
        nullif(regexp_extract(name, '\\.([a-z]+)', 1), '') as kind,
        nullif(regexp_extract(name, 'page=[0-9]+', 0), '') as "view"
      from (select *, regexp_extract(url, '[^/]*$', 0) as name from locations)""",
    "lines": """
      select l_orderkey, l_linenumber, l_partkey, l_linenumber as number, l_returnflag as flag,
        case when l_linestatus = 'F' then null else l_linestatus end as status from lineitem""",
}

# The views each view reads.
_NEEDS = {
    "numbered": ["subs"], "catalog": ["numbered"], "worded": ["catalog"], "routed": ["catalog"],
    "live_calls": ["calls"], "cleared": ["edit_log"], "unsafe": ["edit_log"], "authors_raw": ["dc_input"],
    "authors": ["authors_raw"], "affs": ["dc_input"], "author_affs": ["authors", "affs"],
    "tasks": ["catalog"], "verdicts": ["tasks"], "updates": ["catalog"],
    "located": ["locations"], "page_fields": ["locations"],
}


def _with(names: str, sql: str) -> str:
    """The SQL with the named views, and those they read, in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in order) + "\n" + sql


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SHOWN = "select source_key, organization, status_code, size_mb from subs where "
_ACTIVE = (f"case when active then '{fixed.STILL_PROCESSING}' "
           f"else '{fixed.NO_LONGER_PROCESSING}' end")
_ERROR = f"case when status_code = 'MMM' then '{fixed.NO_STATUS}' "
_VERDICT_ERROR = ("case when action = 'maybe' then 'Verdict ''maybe'' is invalid. "
                  "Valid verdicts are: accept, reject' end")
_REASON = (f"coalesce(reason, case action when 'accept' then '{fixed.DEFAULT_REASONS['accept']}' "
           f"else '{fixed.DEFAULT_REASONS['reject']}' end)")
_SCHEME = "nullif(regexp_extract({0}, '^([a-z]+)://', 1), '')"
_HOST = "nullif(regexp_extract({0}, '^[a-z]+://([^/?#]*)', 1), '')"
_PATH = "regexp_extract({0}, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
_PARTS = (f"{_SCHEME.format('location')} as scheme, {_HOST.format('location')} as host, "
          f"{_PATH.format('location')} as path")
_IS_LINK = "(page_id between 1000000 and 1999999)"
_IS_ENDPOINT = "(page_id between 2000000 and 2999999)"


def _last(columns: str, by: str, where: str, view: str = "edit_log", order: str = "desc") -> str:
    return _with(view, f"""
      select {by}, {columns} from (
        select *, row_number() over (partition by {by} order by seq {order}) as rn
        from {view} where {where}) where rn = 1""")


ORACLE: dict[str, str] = {
    # --- filters
    "f_begins": _with("subs", _SHOWN + "left(organization, 1) = '1'"),
    "f_contains": _with("subs", _SHOWN + "organization like '%NOT%'"),
    "f_eq": _with("subs", _SHOWN + "status_code = 'SRS'"),
    "f_is_null": _with("subs", _SHOWN + "organization is null"),
    "f_ne": _with("subs", _SHOWN + "organization <> '5-LOW'"),
    "f_not_null": _with("subs", _SHOWN + "organization is not null"),
    "f_gt": _with("subs", _SHOWN + "size_mb > 250000"),
    "f_ge": _with("subs", _SHOWN + "size_mb >= 400000"),
    "f_lt": _with("subs", _SHOWN + "size_mb < 50000"),
    "f_le": _with("subs", _SHOWN + "size_mb <= 100000"),
    "f_between": _with("subs", _SHOWN + "size_mb between 100000 and 200000"),
    "f_in": _with("subs", _SHOWN + "status_code in ('SSF', 'SPz')"),
    "f_all": _with("subs", _SHOWN + "organization like '2%' and size_mb >= 1000 and not test "
                                    "and status_code in ('SSF', 'SRS')"),
    "f_active_only": _with("subs", _SHOWN + "active"),
    "f_no_tests": _with("subs", _SHOWN + "not test"),
    "f_date_range": _with("subs", _SHOWN + "submission_time >= timestamp '1996-01-01' "
                                           "and submission_time <= timestamp '1997-01-01'"),
    "f_scope": _with("subs", """
      select 'own' as scope, source_key from subs where owner = 1
      union all select 'all', source_key from subs
      union all select 'active', source_key from subs where active"""),
    "f_point_lookup": _with("catalog", """
      select source_id, source_key, status_code from catalog where source_id = 'ds_1_v2.1'"""),
    "f_lookup_test": _with("catalog", """
      select source_id, source_key, status_code from catalog
      where test and source_id = 'ds_3_v3.1'"""),
    # --- status
    "status_report": _with("worded", """
      select source_id, source_id || ': ' || case when active then 'Processing'
        else 'Not processing' end || ' - ' || word as line
      from worded where not test and organization like '1%'
        and submission_time between timestamp '1996-01-01' and timestamp '1997-01-01'"""),
    "status_word": _with("worded", "select source_key, word from worded"),
    "status_short": _with("catalog", f"""
      select source_id, {_ERROR} else source_id || ': ' || {_ACTIVE} end as line from catalog"""),
    "status_verbose": _with("catalog", f"""
      select source_id,
        {_ERROR} else 'Status of ' || source_id || chr(10) || {_ACTIVE} end as full_text,
        'Status of ' || source_id || {_ACTIVE} as verbose_text from catalog"""),
    "status_missing": _with("catalog", f"select source_id, {_ERROR} end as error from catalog"),
    "stream_current_status": """
      select cast(user_id as varchar) as source_id, event_type as status, event_id from (
        select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
        from events) where rn = 1""",
    "iso_time": """
      select event_id, case when microsecond(ts) % 1000000 = 0
        then strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
        else strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') end as iso from events""",
    # --- catalog
    "version_number": _with("numbered", "select source_key, source_name, version from numbered"),
    "latest_version": _with("numbered", """
      select source_name, version, source_key, status_code from (
        select *, count(*) over (partition by source_name) as n from numbered)
      where version = n"""),
    "test_routing": _with("routed", """
      select source_key, routed_id, case when test then 'catalog-test' else 'catalog' end
        as search_index, not test as public from routed"""),
    "source_id_parts": _with("routed", """
      select source_key, test as is_test, source_name, version as major,
        cast(1 as bigint) as minor from routed"""),
    "resubmit_guard": _with("subs incoming", f"""
      select incoming_key, source_name, case when not "update"
        and source_name in (select source_name from subs)
        then '{fixed.ALREADY_SUBMITTED}' end as error from incoming"""),
    "incremental_inherit": _with("numbered incoming", """
      select incoming_key, s.version as previous_version,
        coalesce(i.organization, s.organization) as organization,
        coalesce(i.size_mb, s.size_mb) as size_mb
      from incoming i left join (
        select *, count(*) over (partition by source_name) as n from numbered) s
        on i.source_name = s.source_name and s.version = s.n"""),
    "metadata_overlay": _with("catalog updates", """
      select source_id, coalesce(u.title, 'title of ' || source_name) as title
      from catalog join updates u using (source_id)"""),
    "update_eligible": _with("worded updates", """
      select u.source_id, u.requester from updates u join worded c
        on u.source_id = c.source_id and u.requester = c.owner
      where not active and word = 'Succeeded'"""),
    "metadata_update_flow": _with("worded updates", """
      select c.source_id, coalesce(u.title || case when length(c.source_id) % 2 = 0
        then ' again' else '' end, 'title of ' || source_name) as title
      from worded c left join updates u on u.source_id = c.source_id
        and u.requester = c.owner and not active and word = 'Succeeded'"""),
    "org_registry": _with("subs", """
      select source_key, case when organization <> '5-LOW' then organization end as organization
      from subs"""),
    "org_ancestors": """
      with recursive up as (
        select p_partkey as org, p_partkey // 2 as ancestor, 1 as depth from part
        where p_partkey > 0
        union all
        select org, ancestor // 2, depth + 1 from up where ancestor > 0)
      select org, ancestor, depth from up""",
    "org_with_ancestors": """
      with recursive up as (
        select p_partkey as org, p_partkey // 2 as ancestor from part where p_partkey > 0
        union all select org, ancestor // 2 from up where ancestor > 0)
      select o_orderkey as source_key, o_custkey as organization from orders
      union all select o_orderkey, ancestor from orders join up on o_custkey = org""",
    # --- citation block
    "dc_titles": _with("dc_input", """
      select submission_id, 0 as pos, title from dc_input where title <> ''
      union all select submission_id, 1, tag1 from dc_input where title <> ''"""),
    "dc_author_names": _with("authors", """
      select submission_id, pos, creator_name, family, given from authors"""),
    "dc_affiliations": _with("author_affs", "select * from author_affs"),
    "dc_creators": _with("authors author_affs", """
      select a.submission_id, a.pos, creator_name, affiliations from authors a left join (
        select submission_id, author_pos, string_agg(affiliation, '|' order by pos)
          as affiliations from author_affs group by 1, 2) f
        on a.submission_id = f.submission_id and a.pos = f.author_pos"""),
    "dc_defaults": _with("dc_input", """
      select submission_id, publisher, 'Dataset' as general,
        case when size % 5 = 0 then tag1 else 'Dataset' end as specific from dc_input"""),
    "dc_year": _with("dc_input", "select submission_id, year as publication_year from dc_input"),
    "dc_optional": _with("dc_input", """
      select submission_id, case when size % 2 = 0 then subject1 end as description,
        case when size % 2 = 0 then 'Other' end as description_type, doi as identifier,
        case when doi is not null then 'DOI' end as identifier_type from dc_input"""),
    "dc_related": _with("dc_input", """
      select submission_id, pos, doi || case pos when 0 then '/a' else '/b' end as related,
        'DOI' as related_type, 'IsPartOf' as relation
      from dc_input, (values (0), (1)) t(pos) where doi is not null"""),
    "dc_subjects": _with("dc_input", """
      select submission_id, 0 as pos, subject1 as subject from dc_input
      union all select submission_id, 1, tag1 from dc_input"""),
    "dc_extra": _with("dc_input", """
      select submission_id, 'publisher' as field, publisher as value from dc_input
      union all select submission_id, 'publicationYear', year from dc_input
      union all select submission_id, 'other', '5' from dc_input
      union all select submission_id, 'sizes', cast(size as varchar) from dc_input"""),
    "dc_block": _with("dc_input authors", """
      select d.submission_id, case when title <> '' then title end as title,
        case when title <> '' then 2 else 0 end as n_titles, coalesce(a.n, 0) as n_creators,
        a.creator_name as first_creator, publisher, year as publication_year,
        case when size % 5 = 0 then tag1 else 'Dataset' end as resource_type, doi,
        case when doi is null then 0 else 2 end as n_related, 2 as n_subjects
      from dc_input d left join authors a on d.submission_id = a.submission_id and a.pos = 0"""),
    "tags_subjects": _with("dc_input", """
      select submission_id, subject1 as tag from dc_input
      union select submission_id, tag1 from dc_input
      union select submission_id, 'tag ' || subject1 from dc_input"""),
    "source_name_clean": _with("dc_input", """
      select submission_id, case when size % 10 <> 0 then trim(regexp_replace(
        lower('The ' || p_name || ' (' || tag1 || ')!'), '[^a-z0-9]+', '_', 'g'), '_') end
        as source_name from dc_input"""),
    "coerce_list": _with("dc_input", """
      select submission_id, 0 as pos, case when submission_id % 3 = 2 then cast(size as varchar)
        else subject1 end as item from dc_input
      union all select submission_id, 1, tag1 from dc_input where submission_id % 3 = 1"""),
    # --- submissions
    "submission_json": _with("dc_input authors", """
      select d.submission_id,
        'dc,data_sources,test,update,placement'
          || case when size % 3 = 0 then ',custom' else '' end
          || case when size % 8 = 0 then ',extraction_config' else '' end
          || case when size % 2 = 0 then ',services,tags' else '' end
          || case when size % 4 = 1 then ',curation' else '' end
          || ',update_metadata_only' as blocks,
        case when title <> '' then title end as title, a.creator_name as first_creator,
        case when size % 5 <> 0 then '["https://x.org/' || tag1 || '"]' else '[]' end
          as data_sources,
        case when size % 2 = 0 then '{"publish":true,"registry":{"collection":'
          || cast(size as varchar) || '}}' end as services,
        '{' || concat_ws(',', case when size % 4 = 0 then '"organization":"' || tag1 || '"' end,
          case when size % 7 = 0 then '"acl":["public"]' end,
          '"source_name":"' || replace(title, ' ', '_') || '"') || '}' as placement,
        case when size % 3 = 0 then cast(size as varchar) end as custom_size,
        case when size % 2 = 0 then tag1 end as first_tag
      from dc_input d left join authors a on d.submission_id = a.submission_id and a.pos = 0"""),
    "metadata_update_projection": _with("dc_input", """
      select submission_id, 'dc,placement' || case when size % 3 = 0 then ',custom' else '' end
        || case when size % 2 = 0 then ',tags' else '' end as blocks from dc_input"""),
    "service_routing": _with("edit_log", """
      select submission_id, key as service,
        case when value < 3 then 'true' else payload end as parameters
      from (select *, row_number() over (partition by submission_id, key order by seq desc) as rn
        from edit_log) where rn = 1 and not (value >= 3 and value < 6)"""),
    "source_manifest": _with("located", f"""
      select page_id, pos, location, {_PARTS} from (
        select page_id, 0 as pos, location from located
        union all select page_id, 1, 'googledrive:///' || cast(page_id as varchar)
        from located)"""),
    "destination_manifest": _with("located", f"""
      select page_id, 0 as pos, location, {_PARTS} from located
      where {_IS_LINK} or {_IS_ENDPOINT}"""),
    "url_parts": _with("locations", f"""
      select page_id, {_SCHEME.format('url')} as scheme, {_HOST.format('url')} as host,
        {_PATH.format('url')} as path from locations"""),
    "url_canonical": _with("located", "select page_id, location from located"),
    # --- validation
    "v_required": _with("dc_input", f"""
      select submission_id, case
        when title = '' and size % 30 = 0 then {_quoted(fixed.TITLE_AND_AUTHORS_REQUIRED)}
        when title = '' then {_quoted(fixed.TITLE_REQUIRED)}
        when size % 30 = 0 then {_quoted(fixed.AUTHORS_REQUIRED)} end as error
      from dc_input"""),
    "v_blocks": _with("dc_input", f"""
      select submission_id, case when (title = '' or size % 5 = 0) and size % 6 <> 0
        then '{fixed.BLOCKS_REQUIRED}' end as error from dc_input"""),
    "v_finite": _with("unsafe", """
      select event_id, case when bad then 'Error: Your custom block is invalid' end as error
      from unsafe"""),
    "v_custom_keys": _with("dc_input", """
      select submission_id, case when size % 14 > 10
        then 'A custom block has at most 10 fields' end as error from dc_input"""),
    "v_custom_desc": _with("dc_input", """
      select submission_id, 'Description without a field: '
        || case when size % 3 <> 0 then 'other_desc' when size % 14 = 0 then 'f1_desc' end as error
      from dc_input"""),
    "v_passthrough_http": _with("locations", """
      select page_id, case when page_id % 2 = 0 and page_id < 1000000
        then 'HTTP(S) data sources are not supported with pass-through' end as error
      from locations"""),
    "v_destination": _with("locations", f"""
      select page_id, case when not ({_IS_LINK} or {_IS_ENDPOINT})
        then 'Data destinations must be endpoint locations' end as error from locations"""),
    "v_verdict": _with("verdicts", f"""
      select source_key, action, {_VERDICT_ERROR} as error from verdicts"""),
    # --- folds
    "fold_append": _with("edit_log", """
      select submission_id, key, row_number() over (partition by submission_id, key order by seq)
        as pos, payload from edit_log where op = 'append'"""),
    "fold_last": _last("key, payload", "submission_id", "op = 'set'"),
    "fold_upsert": _last("payload, event_id", "submission_id, key", "op = 'upsert'"),
    "fold_delete": _with("edit_log", """
      select submission_id, key, payload from (
        select *, row_number() over (partition by submission_id, key order by seq desc) as rn
        from edit_log where op in ('upsert', 'delete')) where rn = 1 and op = 'upsert'"""),
    "fold_first": _last("payload, event_id", "submission_id, key", "op = 'set'", "cleared", "asc"),
    "fold_clear": _with("cleared", """
      select submission_id, key, op, event_id, payload from cleared"""),
    "fold_reset": _with("edit_log", """
      select submission_id, key, op, event_id from edit_log e
        left join (select submission_id, key, max(seq) as last from edit_log
          where op = 'clear' and key <> 'k0' group by 1, 2) c using (submission_id, key)
        left join (select submission_id, max(seq) as reset from edit_log
          where op = 'clear' and key = 'k0' group by 1) r using (submission_id)
      where op <> 'clear' and (last is null or seq > last)
        and (key = 'k4' or reset is null or seq > reset)"""),
    "fold_skips_invalid": _last("payload, event_id", "submission_id, key", "not bad", "unsafe"),
    "stream_fold": _with("cleared", """
      select submission_id, key, payload from (
        select *, row_number() over (partition by submission_id, key order by seq desc) as rn
        from cleared where op in ('upsert', 'delete')) where rn = 1 and op = 'upsert'"""),
    "draft_state": _with("live_calls", """
      select submission_id, field, cast(null as varchar) as key,
        row_number() over (partition by submission_id order by seq) as pos, payload
      from live_calls where op = 'append'
      union all
      select submission_id, field, key, null, payload from (
        select *, row_number() over (partition by submission_id, field, key order by seq desc)
          as rn from live_calls where op <> 'append')
      where rn = 1 and payload <> 'null'"""),
    "draft_documents": _with("live_calls", """
      select submission_id, part,
        string_agg(case when field = 'tags' then payload end, '|' order by pos) as tags,
        string_agg(case when field = 'services' then key end, '|' order by key) as services,
        string_agg(case when field = 'projects' then key end, '|' order by key) as projects,
        max(case when field = 'organization' then trim(payload, '"') end) as organization
      from (select submission_id, field, key, payload, case when field = 'organization'
          then 0 else (coalesce(pos, row_number() over (partition by submission_id, field,
            pos is null order by key)) - 1) // 3 end as part, pos from (
          select submission_id, field, cast(null as varchar) as key,
        row_number() over (partition by submission_id order by seq) as pos, payload
      from live_calls where op = 'append'
      union all
      select submission_id, field, key, null, payload from (
        select *, row_number() over (partition by submission_id, field, key order by seq desc)
          as rn from live_calls where op <> 'append')
      where rn = 1 and payload <> 'null') state) placed
      group by submission_id, part"""),
    "custom_desc": _with("dc_input", """
      select submission_id, 'type' as field, subject1 as value from dc_input
      union all select submission_id, 'brand', tag1 from dc_input
      union all select submission_id, 'brand_desc', case when size % 2 = 0
        then 'about ' || tag1 else 'old text' end from dc_input
      union all select submission_id, 'type_desc', 'about ' || tag1 from dc_input
      where size % 2 <> 0"""),
    # --- access and curation
    "acl_effective": _with("acl_input", """
      select source_key, base as principal from acl_input
      union select source_key, extra from acl_input where extra is not null"""),
    "acl_entry_visible": _with("acl_input principals", """
      select source_key from acl_input where base in (select principal from principals)
        or extra in (select principal from principals)"""),
    "acl_record_visible": _with("acl_input principals", """
      select source_key from acl_input where base in (select principal from principals)"""),
    "curation_eligible": _with("acl_input", """
      select source_key from acl_input where base = 'public' or base = 'supplier_1' or base in (
        select 'nation_' || cast(s_nationkey as varchar) from supplier
        where s_suppkey = 1 and s_suppkey % 3 <> 0)"""),
    "curation_available": _with("tasks", """
      select source_id from tasks where organization is not null"""),
    "curation_summary": _with("tasks", """
      select source_id, submitter, waiting_since, extraction_summary,
        source_id || ' by ' || cast(submitter as varchar) || chr(10) || 'Waiting since '
          || waiting_since || chr(10) || extraction_summary || chr(10) as summary from tasks"""),
    "curation_list": _with("tasks", """
      select source_id, submitter, waiting_since, extraction_summary,
        source_id || ' by ' || cast(submitter as varchar) || chr(10) || 'Waiting since '
          || waiting_since || chr(10) || extraction_summary || chr(10) as summary from tasks
      where organization in ('1-URGENT', '2-HIGH')"""),
    "canonical_json": _with("tasks", """
      select source_id, '{"curation_start_date":"' || waiting_since || '","extraction_summary":"'
        || extraction_summary || '","source_id":"' || source_id
        || '","submission_info":{"submitter":' || cast(submitter as varchar) || '}}' as json
      from tasks"""),
    "canonical_open": """
      select event_id, '{"mrr":{"a":{"m":true,"n":null},"props":' || replace(props, ' ', '')
        || ',"z":[{"b":"' || event_type || '","y":' || event_id || '}]},"projects":{"one":'
        || replace(props, ' ', '') || ',"two":{"c":"x","d":1}}}' as json from events""",
    "curation_apply": _with("tasks verdicts", f"""
      select source_id, action, {_REASON} as reason,
        case action when 'accept' then 'continues' else 'failed' end as outcome
      from tasks join verdicts using (source_id) where action <> 'maybe'"""),
    "curation_unknown": _with("tasks verdicts", f"""
      select source_id, action, '{fixed.TASK_NOT_FOUND}' as error from verdicts
      where action <> 'maybe' and source_id not in (select source_id from tasks)"""),
    # --- records
    "index_json": """
      select event_id, cast(regexp_extract(props, '"k": ([0-9]+)', 1) as bigint) as k,
        cast(null as varchar) as y from events""",
    "index_nested": """
      select p_partkey, p_brand as mark, '["' || replace(p_name, ' ', '","') || '"]' as words,
        p_size as units, case when p_partkey % 4 <> 1 then p_retailprice end as price,
        cast(null as date) as ends from part""",
    "index_by_submission": r"""
      with files as (select p_partkey as k, p_partkey % 15 as submission_id, p_type as t,
          p_size as size, p_name, substring(p_brand, 7) as brand,
          p_brand || '-' || p_partkey || '_' || p_name || '.dat' as name from part),
      found as (
        select submission_id, 'json' as data_type, name, 0 as at, case submission_id
            when 0 then '{"a":{"grade":"' || t || '","id":"' || k || '"}}'
            when 5 then '{' || case when t <> 'PROMO' then '"a":{"grade":"' || t || '"},' else '' end
              || '"b":"[' || size || ',' || (size + 1) || ']"}'
            else '{"c":{"id":"' || k || '"}}' end as record
          from files where submission_id in (0, 5, 10)
        union all select submission_id, 'json', name, 1, case submission_id
            when 0 then '{"a":{"id":"-1"}}' else '{"c":{"id":"-1"}}' end
          from files where submission_id in (0, 10) and k % 2 = 0
        union all select submission_id, 'csv', name, 0, case submission_id
            when 1 then '{"a":{"code":"' || k || '","grade":"' || t || ' \"x\",\n"}}'
            when 6 then '{"a":{"code":"' || k || '"},"note":" "}'
            else '{"note":"5\" wide"}' end
          from files where submission_id in (1, 6, 11)
        union all select submission_id, 'csv', name, 1, case submission_id
            when 1 then '{"a":{"code":"end","grade":"' || t || '"},"note":"ok"}'
            else '{"a":{"code":"end"}}' end
          from files where submission_id in (1, 6)
        union all select submission_id, 'xml', name, 0, case submission_id
            when 2 then '{"a":{"grade":"' || t || '","kind":"k' || k || '"}}'
            when 7 then '{"b":"0' || size || '"}'
            else '{"c":{"x":"{\"grade\":\"' || t || '\"}"}}' end
          from files where submission_id in (2, 7, 12)
        union all select submission_id, 'yaml', name, 0, case submission_id
            when 3 then '{"a":{"grade":"' || t || '","id":"' || k || '"}}'
            when 8 then '{"b":"' || k || '"}' else '{"a":{"grade":"' || t || '"}}' end
          from files where submission_id in (3, 8, 13)
        union all select submission_id, 'yaml', name, 1, case submission_id
            when 3 then '{"a":{"id":"' || k || '"}}' else '{"b":"' || k || '"}' end
          from files where submission_id in (3, 8)
        union all select submission_id, 'filename', name, 0, case submission_id
            when 4 then '{"a":{"brand":"' || brand || '","id":"' || k || '"}}'
            else '{"b":"' || regexp_extract(name, '[a-z]+\.dat$') || '"}' end
          from files where submission_id in (4, 9))
      select * from found""",
    "index_csv": _with("lines", """
      select l_orderkey, l_linenumber, number, flag, status, cast(null as varchar) as comment
      from lines"""),
    "index_csv_headers": """
      select l_orderkey as "order", cast(l_linenumber as bigint) as line,
        case when l_linenumber % 3 < 2 and l_linestatus <> 'F' then l_linestatus end as status,
        case when l_linenumber % 3 < 2 then l_partkey end as part from lineitem""",
    "index_na_values": """
      select l_orderkey, l_linenumber,
        case when l_returnflag not in ('A', 'N') then l_returnflag end as flag,
        case when l_linestatus = 'F' then ' ' when l_linestatus not in ('A', 'N')
          then l_linestatus end as status from lineitem""",
    "index_xml": """
      select p_partkey, p_type as kind, p_size as size, cast(null as varchar) as gone
      from part""",
    "index_yaml": """
      select p_partkey, p_type as kind, p_size as size, cast(null as varchar) as gone
      from part""",
    "index_filename": _with("page_fields", """
      select page_id, number, kind, "view" from page_fields
      where number is not null or kind is not null or "view" is not null"""),
    "group_by_dir": _with("page_fields", """
      select regexp_extract(url, '^.*/', 0) as directory, count(*) as n_files,
        min(url) as first_file, max(url) as last_file,
        arg_min(kind, url) filter (kind is not null) as kind,
        arg_min("view", url) filter ("view" is not null) as "view"
      from page_fields
      where number is not null or kind is not null or "view" is not null group by 1"""),
    "index_union": _with("lines", """
      select p_partkey, p_brand as kind, p_size as units, cast(null as varchar) as status
      from part
      union all select l_partkey, flag, null, status from lines"""),
    "passthrough_filter": _with("locations", """
      select page_id, url from locations where page_id % 3 = 0 or page_id % 2 <> 0"""),
}
ORACLE["stream_draft"] = ORACLE["draft_state"]
ORACLE["version_batches"] = ORACLE["version_number"]
ORACLE["overlay_buckets"] = ORACLE["metadata_overlay"]
