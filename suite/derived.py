"""Tables derived from the given ones, in SQL that Spark and DuckDB both read.

None of them needs a window: positions and page numbers come from the keys, so each is one scan.
"""

DERIVED = {
    # Listing pages: 10 pages a section, noise among the names, some items listed again on the next page.
    "listing_src": """
        select c_nationkey * 100000 + cast(floor(c_custkey / 2500) as bigint) as section,
               cast(floor((c_custkey % 2500) / 250) as bigint) + 1 as page_no,
               c_custkey % 250 as pos,
               case when c_custkey % 11 = 0 then concat('20', cast(10 + c_custkey % 15 as string), ' Films')
                    when c_custkey % 13 = 0 then concat(c_name, ' web series')
                    when c_custkey % 17 = 0 then concat(c_name, ' FULL download')
                    else c_name end as name,
               concat('https://site.example.com/',
                      case when c_custkey % 19 = 0 then 'web-series/' else 'item/' end,
                      cast(c_custkey as string)) as url,
               c_custkey % 23 <> 0 as has_icon,
               c_custkey
        from customer""",
    "listing": """
        select section, page_no, pos, name, url from listing_src
        union all
        select section, page_no + 1, pos + 250, concat(name, ' (again)'), url from listing_src
        where c_custkey % 7 = 0""",
    "section": """
        select distinct section, section as pos,
               concat('Part ', cast(section as string), case when section % 6 = 5 then ' extra'
                      else concat(' of ', cast(1990 + section % 35 as string)) end) as name
        from listing_src""",
    "next_link": """
        select distinct section,
               concat('/', cast(section as string), '/', cast(page_no as string)) as page_url,
               concat('/', cast(section as string), '/',
                      cast(case when page_no < 10 then page_no + 1 else page_no end as string)) as next_url,
               page_no
        from listing_src""",
    "redirect": """
        select s_suppkey as src, cast(floor(s_suppkey / 2) as bigint) as dst from supplier
        where s_suppkey > 0""",
    "variant_file": """
        select l_orderkey as item_id,
               l_linenumber * 10000000000000000 + l_partkey * 100000000
                 + cast(round(l_extendedprice * 100) as bigint) as pos,
               concat(l_returnflag, l_linestatus) as label,
               concat('/file/', cast(l_orderkey as string), '/', cast(l_partkey as string)) as url,
               concat('File Size: ', cast(cast(l_quantity as int) as string),
                      case when l_linenumber % 3 = 0 then ' GB' when l_linenumber % 5 = 0 then ' KB'
                           else ' MB' end) as size_text,
               case when l_linenumber % 4 = 0 then '' when l_linenumber % 2 = 1
                    then concat(cast(l_linenumber as string), 'h ', cast(l_partkey as string)) end as duration,
               case when l_partkey % 4 = 0 then concat('/d1/', cast(l_partkey as string))
                    when l_partkey % 4 = 1 then '' end as file_url_1,
               case when l_partkey % 3 = 0 then concat('/d2/', cast(l_partkey as string)) end as file_url_2,
               case when l_partkey % 5 = 0 then concat('/v1/', cast(l_partkey as string)) end as view_url_1,
               cast(null as string) as view_url_2
        from lineitem""",
    "catalog": """
        select concat('/', source, '/', cast(doc_id as string), '/') as id,
               concat('/', source, '/', cast(doc_id as string), '/') as slug,
               concat('https://old.example.com/', source, '/', cast(doc_id as string), '/') as item_url,
               text as name, cast(2000 + doc_id % 25 as int) as year, lang as language,
               case when doc_id % 5 = 0 then 'http://'
                    when doc_id % 5 = 1 then concat('https://img.example.com/p/', cast(doc_id as string), '.jpg?s=1')
                    when doc_id % 5 = 2 then concat('/p/', cast(doc_id as string), '.jpg')
                    when doc_id % 5 = 3 then '' end as poster_ref
        from documents where doc_id % 3 <> 0""",
    "catalog_stage": """
        select concat('/', source, '/', cast(doc_id as string), '/') as slug,
               concat('https://new.example.com/', source, '/', cast(doc_id as string), '/') as item_url,
               concat(text, ' v2') as name,
               case when doc_id % 4 <> 0 then cast(2001 + doc_id % 25 as int) end as year,
               case when doc_id % 5 <> 0 then lang end as language
        from documents where doc_id % 2 = 0""",
    "variant": """
        select concat(slug, 'HD') as id, slug as item_id, 'HD' as label, '700.00 MB' as file_size,
               concat('/old', slug) as file_url_1 from catalog
        union all
        select concat(slug, 'SD'), slug, 'SD', '300.00 MB', null from catalog where year % 2 = 0
        union all
        select concat(slug, 'X'), concat('/gone', slug), 'X', null, null from catalog where year = 2003""",
    "variant_stage": """
        select concat('https://', case when doc_id % 10 = 0 then 'gone' else 'new' end, '.example.com/', source,
                      '/', cast(doc_id as string), '/') as item_url,
               'HD' as label, concat(cast(n_chars as string), '.00 MB') as file_size,
               concat('/fresh/', cast(doc_id as string)) as file_url_1
        from documents where doc_id % 2 = 0
        union all
        select concat('https://old.example.com/', source, '/', cast(doc_id as string), '/'), 'SD', null,
               concat('/late/', cast(doc_id as string))
        from documents where doc_id % 2 = 1 and doc_id % 3 <> 0 and doc_id % 4 = 3""",
    "work_queue": """
        select event_id as id, concat('/item/', cast(user_id as string)) as url,
               case event_type when 'view' then 'pending' when 'click' then 'processing'
                    when 'purchase' then 'done' when 'error' then 'error' end as status,
               case when event_id % 4 <> 3 then cast(event_id % 4 as int) end as priority,
               ts as queued_at, user_id
        from events""",
    "run_log": """
        select event_id as id, user_id, ts as refresh_time,
               case event_type when 'purchase' then 'completed' when 'error' then 'failed'
                    else 'inprogress' end as status,
               case event_type when 'purchase' then ts + interval '4' minute
                    when 'error' then ts + interval '1' minute end as finished_at
        from events where event_type in ('purchase', 'error', 'view')""",
    "run_request": """
        select event_id as id, user_id, user_id % 10 as item_id, ts as requested_at
        from events where event_type = 'click'""",
    # Finished refreshes: done with and without a payload, and failed ones.
    "refresh_log": """
        select event_id as id, user_id % 10 as item_id, ts as requested_at,
               case when event_id % 11 <> 0 then ts + interval '90' second end as completed_at,
               case when event_id % 11 = 0 then 'processing' when event_type = 'purchase' then 'done'
                    else 'failed' end as status,
               case when event_type = 'purchase' and event_id % 11 <> 0 and event_id % 3 <> 0
                    then concat('[', cast(event_id as string), ']') end as payload
        from events where event_type in ('purchase', 'error')""",
    "info_pair": """
        select p_partkey as item_id, 1 as pos, 'Director:' as k, p_brand as v from part
        union all select p_partkey, 2, 'Genres:', concat(p_type, ', ', p_name) from part
        union all select p_partkey, 3, 'Movie Rating:', concat(cast(p_size as string), '/10') from part
        union all select p_partkey, 4, 'director:', p_name from part where p_partkey % 10 = 0""",
    "title_text": """
        select p_partkey as item_id, p_name,
               concat(p_name, ' (', cast(1990 + p_size as string), ') Full Download HD') as title from part""",
    # Three levels of pages behind a file page, with missing links; all addresses are full ones.
    "chain_link": """
        select concat('/f/', cast(s_suppkey as string)) as page_url, 1 as pos, 'links' as box,
               'Server 1' as anchor_text, concat('s/', cast(s_suppkey as string), '/1') as href,
               concat('/s/', cast(s_suppkey as string), '/1') as abs_url from supplier
        union all select concat('/f/', cast(s_suppkey as string)), 2, 'links', 'Mirror of Server 1', 'x', '/x'
        from supplier
        union all select concat('/f/', cast(s_suppkey as string)), 3, 'links', 'Server 2',
               concat('s/', cast(s_suppkey as string), '/2'), concat('/s/', cast(s_suppkey as string), '/2')
        from supplier where s_suppkey % 5 <> 0
        union all select concat('/f/', cast(s_suppkey as string)), 0, 'other', 'Server 2', 'y', '/y' from supplier
        union all select concat('/s/', cast(s_suppkey as string), '/1'), 1, 'links', 'File Server 1',
               concat('d/', cast(s_suppkey as string), '/1'), concat('/d/', cast(s_suppkey as string), '/1')
        from supplier where s_suppkey % 3 <> 0
        union all select concat('/s/', cast(s_suppkey as string), '/2'), 4, 'links', 'File Server 2',
               concat('d/', cast(s_suppkey as string), '/2'), concat('/d/', cast(s_suppkey as string), '/2')
        from supplier
        union all select concat('/d/', cast(s_suppkey as string), '/1'), 1, 'links', 'File Server 1',
               concat('get/', cast(s_suppkey as string), '/1'), concat('/get/', cast(s_suppkey as string), '/1')
        from supplier
        union all select concat('/d/', cast(s_suppkey as string), '/2'), 1, 'links', 'File Server 2',
               concat('get/', cast(s_suppkey as string), '/2'), concat('/get/', cast(s_suppkey as string), '/2')
        from supplier where s_suppkey % 7 <> 0""",
    "config": """
        select concat('base_', cast(s_suppkey as string)) as key,
               concat('https://h', cast(s_suppkey as string), '.example.com/') as url from supplier""",
    "capture": """
        select url, html, page_id as captured_at from pages
        union all select url, concat(html, '<!-- later -->'), page_id + 1000000 from pages where page_id % 2 = 0
        union all select url, concat('<!-- earlier -->', html), page_id - 1000000 from pages where page_id % 3 = 0""",
}

_BASE_OF = {
    "listing_src": ("customer",), "listing": ("listing_src",), "section": ("listing_src",),
    "next_link": ("listing_src",), "redirect": ("supplier",), "variant_file": ("lineitem",),
    "catalog": ("documents",), "catalog_stage": ("documents",), "variant": ("catalog",),
    "variant_stage": ("documents",), "work_queue": ("events",), "run_log": ("events",),
    "run_request": ("events",), "refresh_log": ("events",), "info_pair": ("part",),
    "title_text": ("part",), "chain_link": ("supplier",), "config": ("supplier",), "capture": ("pages",),
}
USES = _BASE_OF
