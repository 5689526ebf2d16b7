"""DuckDB oracle SQL, one per query key (driver tables as views).

Written independently of the Spark code: plain SQL over the same tables.
Column names equal the Spark outputs.  See README for the fixtures whose
mapping differs from FIXTURES.md and why.
"""

ORACLES = {
    'address': (
        "select s_suppkey, coalesce(nullif(s_name,'Supplier#000000001') || ', ','') || coalesce(nullif(n_name,'NATION_3'),r_name,'') || ', ' || coalesce(r_name || ', ','') as loc from supplier left join nation on s_nationkey=n_nationkey left join region on n_regionkey=r_regionkey"
    ),
    'append_by_name': (
        "select o_orderkey,o_orderstatus,cast(null as varchar(50)) as detail from orders where o_orderstatus<>'O' union all select o_orderkey,o_orderstatus,o_orderpriority from orders where o_orderstatus='O'"
    ),
    'case_key_join': (
        "select p.p_partkey, n_name from part p left join nation on case when p_type='PROMO' then cast(replace(p_brand,'Brand#','') as int) when p_type='LARGE' then p_size end = n_nationkey"
    ),
    'category_label': (
        "select p_partkey, case when a='NONE' and b='NONE' then 'NONE' when a='PROMO' and b is not null then b when a='NONE' and b is not null then b when b='NONE' and a is not null then a when a is null and b is null then 'NOCAT' else concat(coalesce(a,''),' ',coalesce(b,'')) end as cat from (select p_partkey,case when p_size%5=0 then 'NONE' when p_size%7=0 then null else p_type end as a,case when p_size%3=0 then 'NONE' when p_size%11=0 then null else p_brand end as b from part) t"
    ),
    'category_values': (
        'select distinct p_type from part join lineitem on l_partkey=p_partkey'
    ),
    'change_guard': (
        "select s.id,case when s.upd>t.upd or coalesce(s.sub,-1)<>coalesce(t.sub,-1) then 1 else 0 end as changed from (select o_orderkey as id,o_orderstatus as st,o_orderdate as upd,cast(floor(o_totalprice) as bigint)%3 as sub from orders where o_orderpriority<>'4-NOT SPECIFIED') s join (select o_orderkey as id,'old' as st,case when o_orderkey%4=0 then o_orderdate - interval 5 day when o_orderkey%4=1 then null else o_orderdate end as upd,case when o_orderkey%6=0 then null else cast(floor(o_totalprice) as bigint)%3 end as sub from orders where o_orderpriority<>'1-URGENT') t on s.id=t.id"
    ),
    'change_window': (
        "select * from (select o_orderkey as id,o_orderstatus as st,o_orderdate as upd,cast(floor(o_totalprice) as bigint)%3 as sub from orders where o_orderpriority<>'4-NOT SPECIFIED') s where upd>timestamp'2001-06-01' - interval 1 hour or sub=2 or upd between timestamp'1999-01-01' - interval 14 day and timestamp'1999-01-01'"
    ),
    'conditional_price': (
        'select p_partkey,case when p_size=7 and p_retailprice>0 then p_retailprice end as price from part'
    ),
    'const_null_cols': (
        "select p_partkey,'False' as patella_flag,cast(null as double) as price from part"
    ),
    'country_choice': (
        "select s_suppkey,case when n_name in ('NATION_1','NATION_2','NATION_3') then n_regionkey else n_nationkey end as price_list from supplier join nation on s_nationkey=n_nationkey"
    ),
    'cross_categories': (
        'select s_suppkey,r_name from supplier join region on 1=1'
    ),
    'date_prefix': (
        "select o_orderkey,cast(o_orderdate as date) as d from orders"
    ),
    'date_text': (
        "select o_orderkey, upper(strftime(strptime(substr(cast(o_orderdate as varchar),1,10),'%Y-%m-%d'),'%d-%b-%Y')) as d from orders"
    ),
    'delete_missing': (
        "select id,st,upd from (select o_orderkey as id,'old' as st,case when o_orderkey%4=0 then o_orderdate - interval 5 day when o_orderkey%4=1 then null else o_orderdate end as upd,case when o_orderkey%6=0 then null else cast(floor(o_totalprice) as bigint)%3 end as sub from orders where o_orderpriority<>'1-URGENT') t where not (id not in (select o_orderkey from orders where o_orderpriority<>'4-NOT SPECIFIED'))"
    ),
    'derive_on_write': (
        "select o_orderkey, regexp_replace(o_orderpriority, '^(.+)[AB\\\\\\-].*', '\\1') as s from orders"
    ),
    'description_override': (
        "select p_partkey,case when (p_name like 'blue%' or p_name like 'red%') and nullif(p_type,'PROMO') is not null then p_type else p_name end as description from part"
    ),
    'directory': (
        "select c.c_custkey,c.c_name,n.n_name,a.s_name as hospital,'(' || coalesce(cast(ph.event_id as varchar(20)),'') || ')' as phone,em.event_id as email from customer c left join nation n on n.n_nationkey=c.c_nationkey join supplier a on a.s_suppkey=n.n_nationkey+1 and upper(c.c_mktsegment)='BUILDING' left join events ph on ph.event_id=c.c_custkey and ph.event_type='error' left join events em on em.event_id=c.c_custkey+1 and em.event_type='view'"
    ),
    'duplicate_keys': (
        'select l_orderkey,l_linenumber,count(*) as n from lineitem group by l_orderkey,l_linenumber having count(*)>1'
    ),
    'enforce_schema': (
        'select cast(s_suppkey as bigint) as hospital_id,cast(s_name as varchar(100)) as hospital,cast(s_nationkey%2 as int) as iuni from supplier'
    ),
    'exists_flags': (
        "select distinct o_custkey, case when b.k is null then 0 else 1 end as iview, case when c.k is null then 0 else 1 end as dof from orders left join (select user_id as k from events where event_type='error') b on o_custkey=b.k left join (select user_id as k from events where value>90) c on o_custkey=c.k"
    ),
    'flag_gate': (
        'select l_orderkey,l_linenumber,l_partkey,case when order_flag=1 then l_returnflag else null end as detail from (select l_orderkey,l_linenumber,l_partkey,l_suppkey,l_quantity,l_returnflag,l_linestatus,l_shipdate,case when p_size>=40 then 1 else 0 end as flag,max(case when p_size>=40 then 1 else 0 end) over (partition by l_orderkey) as order_flag from lineitem left join part on l_partkey=p_partkey) x'
    ),
    'full_refresh': (
        'select o_orderkey,o_orderstatus,o_orderdate from orders'
    ),
    'hospital_product': (
        "with pi as (select l_suppkey as price_list_id,case when l_linenumber<=3 then 'A1' when l_linenumber<=6 then 'A2' else 'A3' end as attr,p_partkey as item,case when p_size=7 and l_extendedprice>0 then p_retailprice end as price from lineitem join orders on o_orderkey=l_orderkey left join part on case when l_linenumber<=3 then l_partkey when l_linenumber<=6 then l_partkey+1 end=p_partkey where timestamp'2000-06-01' between coalesce(nullif(o_orderdate,timestamp'1998-10-03'),timestamp'2000-06-01') and coalesce(case when o_orderstatus='P' then o_orderdate + interval 900 day end,timestamp'2000-06-01' + interval 1 day) and (l_linenumber>6 or p_partkey is not null)), pp as (select distinct c_custkey as hospital_id,c_name as hospital,c_nationkey%2 as req,case when n_name in ('NATION_1','NATION_2','NATION_3') then adv.s_suppkey else n_nationkey end as price_list_id,n_name as country from customer left join (select * from supplier where s_acctbal>0) adv on (adv.s_suppkey=c_nationkey+1 or adv.s_suppkey=c_custkey) join nation on n_nationkey=c_nationkey), u as (select hospital_id,hospital,req,case when req=1 then price end as price,nullif(p_type,'LARGE') as cat from pp join pi on pp.price_list_id=pi.price_list_id join part on p_partkey=item where attr in ('A1','A2') union all select hospital_id,hospital,req,cast(null as double),r_name from pp join pi on pp.price_list_id=pi.price_list_id join region on 1=1 where attr='A3'), w as (select distinct hospital_id,hospital,max(req) over (partition by hospital_id) as req,max(price) over (partition by hospital_id) as price,cat from u) select hospital_id,hospital,req,price,coalesce(max(case when cat='ECONOMY' then 1 end),0) as ECONOMY,coalesce(max(case when cat='LARGE' then 1 end),0) as LARGE,coalesce(max(case when cat='MEDIUM' then 1 end),0) as MEDIUM,coalesce(max(case when cat='PROMO' then 1 end),0) as PROMO,coalesce(max(case when cat='SMALL' then 1 end),0) as SMALL,coalesce(max(case when cat='STANDARD' then 1 end),0) as STANDARD from w group by hospital_id,hospital,req,price"
    ),
    'in_list': (
        "select n_nationkey from nation where n_name in ('NATION_1','NATION_2','NATION_3')"
    ),
    'incremental_refresh': (
        "with src as (select o_orderkey as id,o_orderstatus as st,o_orderdate as upd,cast(floor(o_totalprice) as bigint)%3 as sub from orders where o_orderpriority<>'4-NOT SPECIFIED'), tgt as (select o_orderkey as id,'old' as st,case when o_orderkey%4=0 then o_orderdate - interval 5 day when o_orderkey%4=1 then null else o_orderdate end as upd,case when o_orderkey%6=0 then null else cast(floor(o_totalprice) as bigint)%3 end as sub from orders where o_orderpriority<>'1-URGENT'), chg as (select * from src where upd>timestamp'2000-01-01' or sub=2), kept as (select * from tgt where id in (select id from src)) select coalesce(c.id,k.id) as id, case when k.id is null or (c.id is not null and (c.upd>k.upd or coalesce(c.sub,-1)<>coalesce(k.sub,-1))) then c.st else k.st end as st, case when k.id is null or (c.id is not null and (c.upd>k.upd or coalesce(c.sub,-1)<>coalesce(k.sub,-1))) then c.upd else k.upd end as upd from kept k full outer join chg c on c.id=k.id"
    ),
    'inner_join': (
        'select s_suppkey,n_name,r_name from supplier join nation on s_nationkey=n_nationkey join region on n_regionkey=r_regionkey'
    ),
    'join_latest': (
        'select c_custkey,rev.event_type,rev.ts from customer left join (select user_id,event_type,ts from (select *,row_number() over (partition by user_id order by ts desc,event_id desc) rn from events) e where rn=1) rev on rev.user_id=c_custkey'
    ),
    'kind_or_lookup': (
        "select p_partkey,p_type,n_name from part left join nation on case when p_type='LARGE' then p_size end=n_nationkey where p_type='PROMO' or n_name is not null"
    ),
    'latest_per_key': (
        'select user_id,event_type,ts from (select *,row_number() over (partition by user_id order by ts desc,event_id desc) rn from events) x where rn=1'
    ),
    'left_join': (
        'select o_orderkey,l_linenumber,l_partkey from orders left join lineitem on o_orderkey=l_orderkey'
    ),
    'left_join_filtered': (
        "select c_custkey,event_id from customer left join events on user_id=c_custkey and event_type='error' and value>50"
    ),
    'like_filters': (
        "select p_partkey,case when coalesce(nullif(p_name,'blue ring'),'NOCAT') not like 'blue%' then 1 else 0 end as kept_default from part where nullif(p_name,'blue ring') not like 'red%'"
    ),
    'listagg': (
        "select string_agg(p_type,',' order by p_type) as l from (select distinct p_type from part)"
    ),
    'merge_upsert': (
        "with chg as (select * from (select o_orderkey as id,o_orderstatus as st,o_orderdate as upd,cast(floor(o_totalprice) as bigint)%3 as sub from orders where o_orderpriority<>'4-NOT SPECIFIED') s where upd>timestamp'2000-01-01' or sub=2), kept as (select o_orderkey as id,'old' as st,case when o_orderkey%4=0 then o_orderdate - interval 5 day when o_orderkey%4=1 then null else o_orderdate end as upd,case when o_orderkey%6=0 then null else cast(floor(o_totalprice) as bigint)%3 end as sub from orders where o_orderpriority<>'1-URGENT') select coalesce(c.id,k.id) as id, case when k.id is null or (c.id is not null and (c.upd>k.upd or coalesce(c.sub,-1)<>coalesce(k.sub,-1))) then c.st else k.st end as st, case when k.id is null or (c.id is not null and (c.upd>k.upd or coalesce(c.sub,-1)<>coalesce(k.sub,-1))) then c.upd else k.upd end as upd from kept k full outer join chg c on c.id=k.id"
    ),
    'not_exists': (
        "select o_orderkey from orders where not exists (select 1 from customer where c_mktsegment='BUILDING' and c_custkey=o_custkey)"
    ),
    'not_exists_chain': (
        "select o_orderkey from orders o where not exists (select 1 from lineitem l join part p on l.l_partkey=p.p_partkey join supplier s on l.l_suppkey=s.s_suppkey where p.p_type='PROMO' and s.s_acctbal>0 and l.l_returnflag not in ('R','A') and l.l_orderkey=o.o_orderkey)"
    ),
    'not_expired': (
        "select o_orderkey from orders where case when o_orderstatus='P' then o_orderdate end >= timestamp'2000-01-01'"
    ),
    'not_in_list': (
        "select count(*) as n from orders where nullif(o_orderpriority,'5-LOW') not in ('1-URGENT','2-HIGH')"
    ),
    'null_defaults': (
        "select o_orderkey,coalesce(nullif(case when o_orderpriority='2-HIGH' then '' else nullif(o_orderpriority,'5-LOW') end,''),'X') as rep from orders"
    ),
    'null_filters': (
        "select p_partkey from part where nullif(p_type,'PROMO') is not null and nullif(p_brand,'Brand#1') is not null"
    ),
    'or_join': (
        "select s_suppkey, p_partkey from supplier left join part on (p_partkey=s_nationkey+1 or p_partkey=s_suppkey) and p_type='PROMO'"
    ),
    'order_bound': (
        "select o_orderkey from orders where o_totalprice*2<700001 and o_orderstatus='F'"
    ),
    'order_flag': (
        'select l_orderkey,l_linenumber,l_partkey,flag,order_flag from (select l_orderkey,l_linenumber,l_partkey,l_suppkey,l_quantity,l_returnflag,l_linestatus,l_shipdate,case when p_size>=40 then 1 else 0 end as flag,max(case when p_size>=40 then 1 else 0 end) over (partition by l_orderkey) as order_flag from lineitem left join part on l_partkey=p_partkey) x where flag=1 or order_flag=0'
    ),
    'order_view': (
        "select o_orderkey as order_id,l.l_linenumber as line_no,c_custkey as contact_id,c_name as contact_name,replace(p_brand,'#','') as catalog_number,p_name as description,s_name as site_name,coalesce(s_name || ', ','') || coalesce(n_name,'') || ', ' || coalesce(region.r_name || ', ','') as location,case when l_returnflag='R' and l_quantity<=10 then 'RETURN' when o_orderstatus='P' then case upper(rev.event_type) when 'VIEW' then 'Pending Review' when 'ERROR' then 'Re-Design' when 'PURCHASE' then 'Approved' else o_orderstatus end else o_orderstatus end as status,l_shipdate as commit_date,scan.ts as scan_date,coalesce(nullif(n_name,'NATION_0'),'X') as rep,regexp_replace(p_brand,'^[AB]','0') as serial_ori,flag,order_flag from orders left join (select l_orderkey,l_linenumber,l_partkey,l_suppkey,l_quantity,l_returnflag,l_linestatus,l_shipdate,case when p_size>=40 then 1 else 0 end as flag,max(case when p_size>=40 then 1 else 0 end) over (partition by l_orderkey) as order_flag from lineitem left join part on l_partkey=p_partkey) l on o_orderkey=l.l_orderkey left join part on p_partkey=l.l_partkey left join customer on c_custkey=o_custkey left join supplier on s_suppkey=l.l_suppkey left join nation on n_nationkey=s_nationkey left join region on r_regionkey=n_regionkey left join (select user_id,event_type,ts from (select *,row_number() over (partition by user_id order by ts desc,event_id desc) rn from events) e where rn=1) rev on rev.user_id=o_custkey left join (select user_id,value,ts from (select *,row_number() over (partition by user_id order by ts desc,event_id desc) rn from events where event_type='view') e where rn=1) scan on scan.user_id=o_custkey where c_custkey is not null and (l.l_returnflag || l.l_linestatus) not in ('NF') and (flag=1 or order_flag=0) and p_name not like 'blue%' and (l_returnflag not in ('R','A') or (l_returnflag='R' and l_quantity>10) or (l_returnflag='R' and l_quantity<=10 and l_shipdate>=timestamp'2001-10-05' - interval 30 day) or (l_returnflag='A' and l_shipdate>=timestamp'2001-10-05' - interval 30 day)) and not exists (select 1 from nation x where x.n_name='NATION_9' and x.n_nationkey=c_nationkey)"
    ),
    'order_view_draft': (
        "select o_orderkey as order_id,l.l_linenumber as line_no,c_custkey as contact_id,c_name as contact_name,replace(p_brand,'#','') as catalog_number,p_name as description,s_name as site_name,coalesce(s_name || ', ','') || coalesce(n_name,'') || ', ' || coalesce(region.r_name || ', ','') as location,case when l_returnflag='R' and l_quantity<=10 then 'RETURN' when o_orderstatus='P' then case upper(rev.event_type) when 'VIEW' then 'Pending Review' when 'ERROR' then 'Re-Design' when 'PURCHASE' then 'Approved' else o_orderstatus end else o_orderstatus end as status,l_shipdate as commit_date,scan.ts as scan_date,coalesce(nullif(n_name,'NATION_0'),'X') as rep,regexp_replace(p_brand,'^[AB]','0') as serial_ori,flag,order_flag,case when b.k is null then 0 else 1 end as iview from orders left join (select l_orderkey,l_linenumber,l_partkey,l_suppkey,l_quantity,l_returnflag,l_linestatus,l_shipdate,case when p_size>=40 then 1 else 0 end as flag,max(case when p_size>=40 then 1 else 0 end) over (partition by l_orderkey) as order_flag from lineitem left join part on l_partkey=p_partkey) l on o_orderkey=l.l_orderkey left join part on p_partkey=l.l_partkey left join customer on c_custkey=o_custkey left join supplier on s_suppkey=l.l_suppkey left join nation on n_nationkey=s_nationkey left join region on r_regionkey=n_regionkey left join (select distinct user_id as k from events where event_type='error') b on b.k=o_custkey left join (select user_id,event_type,ts from (select *,row_number() over (partition by user_id order by ts desc,event_id desc) rn from events) e where rn=1) rev on rev.user_id=o_custkey left join (select user_id,value,ts from (select *,row_number() over (partition by user_id order by ts desc,event_id desc) rn from events where event_type='view') e where rn=1) scan on scan.user_id=o_custkey where (l.l_returnflag || l.l_linestatus) not in ('NF') and (flag=1 or order_flag=0) and p_name not like 'blue%' and (l_returnflag not in ('R','A') or (l_returnflag='R' and l_quantity>10 and l_shipdate>=timestamp'2001-10-05' - interval 60 day) or (l_returnflag='R' and l_quantity<=10 and l_shipdate>=timestamp'2001-10-05' - interval 30 day) or (l_returnflag='A' and l_shipdate>=timestamp'2001-10-05' - interval 30 day))"
    ),
    'order_view_lookup': (
        "select o_orderkey as order_id,l.l_linenumber as line_no,c_custkey as contact_id,c_name as contact_name,replace(p_brand,'#','') as catalog_number,case when order_flag=1 then p_name else null end as description, coalesce(m.r_name,'NOCAT') as category, case when m.r_name like 'A%' then 'True' else 'False' end as a_flag,s_name as site_name,coalesce(s_name || ', ','') || coalesce(n_name,'') || ', ' || coalesce(region.r_name || ', ','') as location,case when l_returnflag='R' and l_quantity<=10 then 'RETURN' when o_orderstatus='P' then case upper(rev.event_type) when 'VIEW' then 'Pending Review' when 'ERROR' then 'Re-Design' when 'PURCHASE' then 'Approved' else o_orderstatus end else o_orderstatus end as status,l_shipdate as commit_date,scan.ts as scan_date,coalesce(nullif(n_name,'NATION_0'),'X') as rep,regexp_replace(p_brand,'^[AB]','0') as serial_ori,flag,order_flag from orders left join (select l_orderkey,l_linenumber,l_partkey,l_suppkey,l_quantity,l_returnflag,l_linestatus,l_shipdate,case when p_size>=40 then 1 else 0 end as flag,max(case when p_size>=40 then 1 else 0 end) over (partition by l_orderkey) as order_flag from lineitem left join part on l_partkey=p_partkey) l on o_orderkey=l.l_orderkey left join part on p_partkey=l.l_partkey left join customer on c_custkey=o_custkey left join supplier on s_suppkey=l.l_suppkey left join nation on n_nationkey=s_nationkey left join region on r_regionkey=n_regionkey left join (select user_id,event_type,ts from (select *,row_number() over (partition by user_id order by ts desc,event_id desc) rn from events) e where rn=1) rev on rev.user_id=o_custkey left join (select user_id,value,ts from (select *,row_number() over (partition by user_id order by ts desc,event_id desc) rn from events where event_type='view') e where rn=1) scan on scan.user_id=o_custkey left join (select r_name,substr(r_name,1,1) as code from region where r_regionkey<4) m on substr(p_type,1,1)=m.code where c_custkey is not null and (l.l_returnflag || l.l_linestatus) not in ('NF') and (flag=1 or order_flag=0) and coalesce(p_name,'NOCAT') not like 'blue%' and (l_returnflag not in ('R','A') or (l_returnflag='R' and l_quantity>10) or (l_returnflag='R' and l_quantity<=10 and l_shipdate>=timestamp'2001-10-05' - interval 30 day) or (l_returnflag='A' and l_shipdate>=timestamp'2001-10-05' - interval 30 day))"
    ),
    'outer_to_inner': (
        "select o_orderkey,c_name from orders left join customer on o_custkey=c_custkey and c_acctbal>0 where c_mktsegment not in ('BUILDING')"
    ),
    'party_pricelist': (
        "select distinct c_custkey as hospital_id,c_name as hospital,c_nationkey%2 as req,case when n_name in ('NATION_1','NATION_2','NATION_3') then adv.s_suppkey else n_nationkey end as price_list_id,n_name as country from customer left join (select * from supplier where s_acctbal>0) adv on (adv.s_suppkey=c_nationkey+1 or adv.s_suppkey=c_custkey) join nation on n_nationkey=c_nationkey"
    ),
    'pattern_flag': (
        "select p_partkey,case when p_type like 'S%' then 'True' else 'False' end as f from part"
    ),
    'phone': (
        "select s_suppkey,'(' || coalesce(nullif(cast(s_nationkey as varchar(10)),'3'),'') || ')' || coalesce(nullif(s_name,'Supplier#000000005'),'') || ' ' || coalesce(cast(null as varchar(5)),'') as phone from supplier"
    ),
    'pivot_dynamic': (
        "select s_suppkey,s_name,coalesce(max(case when p_type='ECONOMY' then 1 end),0) as ECONOMY,coalesce(max(case when p_type='LARGE' then 1 end),0) as LARGE,coalesce(max(case when p_type='MEDIUM' then 1 end),0) as MEDIUM,coalesce(max(case when p_type='PROMO' then 1 end),0) as PROMO,coalesce(max(case when p_type='SMALL' then 1 end),0) as SMALL,coalesce(max(case when p_type='STANDARD' then 1 end),0) as STANDARD from (select s_suppkey,s_name,p_type from supplier left join lineitem on l_suppkey=s_suppkey left join part on p_partkey=l_partkey) t group by s_suppkey,s_name"
    ),
    'pivot_fill': (
        "select s_suppkey,s_name,coalesce(max(case when p_type='ECONOMY' then 1 end),0) as ECONOMY,coalesce(max(case when p_type='LARGE' then 1 end),0) as LARGE,coalesce(max(case when p_type='MEDIUM' then 1 end),0) as MEDIUM,coalesce(max(case when p_type='PROMO' then 1 end),0) as PROMO,coalesce(max(case when p_type='SMALL' then 1 end),0) as SMALL,coalesce(max(case when p_type='STANDARD' then 1 end),0) as STANDARD from (select s_suppkey,s_name,p_type from supplier left join lineitem on l_suppkey=s_suppkey left join part on p_partkey=l_partkey) t group by s_suppkey,s_name"
    ),
    'pivot_flags': (
        "select s_suppkey,s_name,coalesce(max(case when p_type='ECONOMY' then 1 end),0) as ECONOMY,coalesce(max(case when p_type='LARGE' then 1 end),0) as LARGE,coalesce(max(case when p_type='MEDIUM' then 1 end),0) as MEDIUM,coalesce(max(case when p_type='PROMO' then 1 end),0) as PROMO,coalesce(max(case when p_type='SMALL' then 1 end),0) as SMALL,coalesce(max(case when p_type='STANDARD' then 1 end),0) as STANDARD from (select s_suppkey,s_name,p_type from supplier left join lineitem on l_suppkey=s_suppkey left join part on p_partkey=l_partkey) t group by s_suppkey,s_name"
    ),
    'portal_view': (
        "select distinct o_orderkey,coalesce(nullif(o_orderpriority,'5-LOW'),'X') as rep, case when (o_orderpriority like '1-U%' or o_orderpriority like '2-H%') and nullif(o_orderstatus,'F') is not null then o_orderstatus else o_orderpriority end as description, o_orderdate as actual_date,o_orderdate as rescheduled_date, case when b.k is null then 0 else 1 end as iview,case when c.k is null then 0 else 1 end as dof,case when d.k is null then 0 else 1 end as iview2 from orders left join (select user_id as k from events where event_type='error') b on o_custkey=b.k left join (select user_id as k from events where value>90) c on o_custkey=c.k left join (select user_id as k from events where event_type='signup') d on o_custkey=d.k"
    ),
    'prefix_lookup': (
        "select p_partkey, coalesce(m.n_name,'NOCAT') as cat from part left join (select n_name,substr(concat(n_name,'xxxx'),8,1) as code from nation where n_regionkey=1) m on substr(p_brand,7,1)=m.code"
    ),
    'pricelist_item': (
        "select l_suppkey as price_list_id,case when l_linenumber<=3 then 'A1' when l_linenumber<=6 then 'A2' else 'A3' end as attr,p_partkey as item,case when p_size=7 and l_extendedprice>0 then p_retailprice end as price from lineitem join orders on o_orderkey=l_orderkey left join part on case when l_linenumber<=3 then l_partkey when l_linenumber<=6 then l_partkey+1 end=p_partkey where timestamp'2000-06-01' between coalesce(nullif(o_orderdate,timestamp'1998-10-03'),timestamp'2000-06-01') and coalesce(case when o_orderstatus='P' then o_orderdate + interval 900 day end,timestamp'2000-06-01' + interval 1 day) and (l_linenumber>6 or p_partkey is not null)"
    ),
    'project_rename': (
        'select o_orderkey as order_id,o_custkey as contact,o_orderdate as actual_date,o_orderdate as rescheduled_date from orders'
    ),
    'reconcile': (
        "select count(*) as n,count(case when o.id is null then 1 end) as only_new,count(case when n.id is null then 1 end) as only_old,count(case when o.id is not null and n.id is not null and o.upd is distinct from n.upd then 1 end) as upd_diff from (select o_orderkey as id,'old' as st,case when o_orderkey%4=0 then o_orderdate - interval 5 day when o_orderkey%4=1 then null else o_orderdate end as upd,case when o_orderkey%6=0 then null else cast(floor(o_totalprice) as bigint)%3 end as sub from orders where o_orderpriority<>'1-URGENT') o full outer join (select o_orderkey as id,o_orderstatus as st,o_orderdate as upd,cast(floor(o_totalprice) as bigint)%3 as sub from orders where o_orderpriority<>'4-NOT SPECIFIED') n on o.id=n.id"
    ),
    'retention': (
        "select l_orderkey,l_linenumber,l_returnflag,l_shipdate from lineitem where l_returnflag not in ('R','A') or (l_returnflag='R' and coalesce(nullif(l_quantity,7),11)>10) or (l_returnflag='R' and l_quantity<=10 and l_shipdate>=timestamp'2001-10-05' - interval 30 day) or (l_returnflag='A' and l_shipdate>=timestamp'2001-10-05' - interval 30 day)"
    ),
    'retention_shipped': (
        "select l_orderkey,l_linenumber,l_returnflag,l_shipdate from lineitem where l_returnflag not in ('R','A') or (l_returnflag='R' and coalesce(nullif(l_quantity,7),11)>10 and l_shipdate>=timestamp'2001-10-05' - interval 30 day) or (l_returnflag='R' and nullif(l_quantity,7)<=10 and l_shipdate>=timestamp'2001-10-05' - interval 30 day) or (l_returnflag='A' and l_shipdate>=timestamp'2001-10-05' - interval 30 day)"
    ),
    'role_playing': (
        'select c_custkey,a.n_name as own,b.n_name as other from customer left join nation a on a.n_nationkey=c_nationkey left join nation b on b.n_nationkey=c_nationkey+1'
    ),
    'serial_prefix': (
        "select p_partkey, regexp_replace(p_brand,'^[AB]','0') as s from part"
    ),
    'serial_suffix': (
        "select o_orderkey, regexp_replace(o_orderpriority, '^(.+)[AB\\\\\\-].*', '\\1') as s from orders"
    ),
    'status_label': (
        "with rev as (select user_id,event_type from (select *,row_number() over (partition by user_id order by ts desc,event_id desc) rn from events) x where rn=1) select o_orderkey, case when o_orderstatus='F' and o_totalprice<=50000 then 'RETURN' when o_orderstatus='P' then case upper(event_type) when 'VIEW' then 'Pending Review' when 'ERROR' then 'Re-Design' when 'PURCHASE' then 'Approved' else o_orderstatus end else o_orderstatus end as status from orders left join rev on user_id=o_custkey"
    ),
    'stream_derive': (
        "select event_id,regexp_replace(event_type,'^[ev]','0') as k from events"
    ),
    'stream_upsert': (
        'select user_id,event_type,ts from (select *,row_number() over (partition by user_id order by ts desc,event_id desc) rn from events) x where rn=1'
    ),
    'status_function': (
        "with r as (select user_id,cast(date_trunc('day',ts) as date) as rev,upper(event_type) as st from events), m as (select user_id,max(rev) as rev from r group by user_id), f as (select r.user_id, case when count(*)=1 then max(st) end as status from r join m on r.user_id=m.user_id and r.rev=m.rev group by r.user_id) select c_custkey, status from customer left join f on user_id=c_custkey"
    ),
    'stream_late_scans': (
        "select o.event_id as order_id, max(s.ts) as scan_ts from events o join events s on s.user_id=o.user_id and s.ts>=o.ts and s.ts<=o.ts + interval 14 day where o.event_type='purchase' and s.event_type='click' group by o.event_id"
    ),
    'strict_latest': (
        "with r as (select user_id,cast(date_trunc('day',ts) as date) as rev,upper(event_type) as st from events), m as (select user_id,max(rev) as rev from r group by user_id) select r.user_id, case when count(*)=1 then max(st) end as status from r join m on r.user_id=m.user_id and r.rev=m.rev group by r.user_id"
    ),
    'strip_hyphen': (
        "select o_orderkey,nullif(replace(case when o_orderpriority='2-HIGH' then '--' else o_orderpriority end,'-',''),'') as cat from orders"
    ),
    'to_number': (
        "select p_partkey,try_cast(replace(p_brand,'Brand#','') || '.5' as double) as n,try_cast(p_type as double) as bad from part"
    ),
    'two_branch_load': (
        "with r0 as (select user_id,cast(date_trunc('day',ts) as date) as rev,upper(event_type) as st from events), m as (select user_id,max(rev) as rev from r0 group by user_id), r as (select r0.user_id, case when count(*)=1 then max(st) end as st from r0 join m on r0.user_id=m.user_id and r0.rev=m.rev group by r0.user_id) select o_orderkey,case when o_orderstatus='P' then coalesce(case r.st when 'VIEW' then 'Pending Review' when 'ERROR' then 'Re-Design' when 'PURCHASE' then 'Approved' end,o_orderstatus) else o_orderstatus end as status,cast(null as varchar(50)) as detail from orders left join r on r.user_id=o_custkey where not exists (select 1 from lineitem l join part p on l.l_partkey=p.p_partkey where p.p_type='PROMO' and l.l_returnflag not in ('R','A') and l.l_orderkey=o_orderkey) union all select o_orderkey,case when o_orderstatus='P' then coalesce(case r.st when 'VIEW' then 'Pending Review' when 'ERROR' then 'Re-Design' when 'PURCHASE' then 'Approved' end,o_orderstatus) else o_orderstatus end,o_orderpriority from orders left join r on r.user_id=o_custkey where exists (select 1 from lineitem l join part p on l.l_partkey=p.p_partkey where p.p_type='PROMO' and l.l_returnflag not in ('R','A') and l.l_orderkey=o_orderkey)"
    ),
    'two_key_join': (
        'select l.l_orderkey,l.l_linenumber,o.c_name from lineitem l left join (select o_orderkey,c_nationkey,c_name from orders join customer on o_custkey=c_custkey) o on l.l_orderkey=o.o_orderkey and l.l_linenumber=o.c_nationkey'
    ),
    'union_window': (
        "select distinct hid, max(req) over (partition by hid) as req, max(price) over (partition by hid) as price, cat from (select s_suppkey as hid, s_nationkey%2 as req, case when s_nationkey%2=1 then p_retailprice end as price, p_type as cat from supplier join lineitem on l_suppkey=s_suppkey join part on p_partkey=l_partkey union all select s_suppkey, s_nationkey%2, cast(null as double), r_name from supplier cross join region where s_acctbal>5000) t"
    ),
    'upper_eq': (
        "select event_id from events where upper(event_type)='VIEW'"
    ),
    'validity': (
        "select o_orderkey from orders where timestamp'2000-01-01' between coalesce(nullif(o_orderdate,timestamp'1998-10-03'),timestamp'2000-01-01') and coalesce(case when o_orderstatus='P' then o_orderdate + interval 900 day end, timestamp'2000-01-01' + interval 1 day)"
    ),
    'widen_schema': (
        'select s_suppkey,s_name,cast(null as bigint) as header_id,cast(null as timestamp) as last_update from supplier'
    ),
    'yes_flag': (
        "select o_orderkey,case when nullif(o_orderstatus,'P')='F' then 1 else 0 end as f from orders"
    ),
}

# after the refresh the stored order table equals the order view
ORACLES['incremental_order_table'] = ORACLES['order_view']
