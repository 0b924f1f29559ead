"""The driver's tables in the shape of the customer-care inputs.

Every view's SQL is the same on Spark and DuckDB but for the ordered joining of texts, {joined(x)} below.
"""

import re

_BUCKET = "concat('2024-', lpad(cast(cast(floor((day(ts)-1)/3.0) as int)+1 as string),2,'0'))"

PHRASES = """VALUES (0,'dava açacağım'), (1,'hattımı taşıyacağım'), (2,'fazla ücret yazılmış'), (3,'İADE istiyorum'),
(4,'internet yok'), (5,'sinyal yok, çekmiyor'), (6,'yine aynı sorun'), (7,'hala devam ediyor'), (8,'bıktım, yeter artık'),
(9,'fatura geldi'), (10,'modem ışığı yanıyor'), (11,'bunu daha önce denedim'), (12,'faturam yüksek'), (13,'merhaba'),
(14,'bilgi almak istiyorum'), (15,'teşekkür ederim'), (16,'paketimi sordum'), (17,'adresim değişti'), (18,'kampanya var mı'),
(19,'iyi günler'), (20,'tarife sorusu'), (21,'şifre unuttum'), (22,'numara bilgisi')"""

AGENT_PHRASES = """VALUES (0,'tekrar eder misiniz'), (1,'faturanıza bakıyorum, fatura kaydı açık'),
(2,'modem ışığını kontrol edelim'), (3,'yardımcı olayım'), (4,'teknik ekip arayacak'), (5,'ücret detayı gönderildi'),
(6,'iyi günler dilerim')"""

_REFERENCE = """select cast(doc_id as string) document_id, concat('# **Belge ', cast(doc_id as string), '** ', source,
        chr(10), 'Kategori: ', case doc_id % 5 when 0 then 'Faturalandırma' when 1 then 'Mobil İnternet' when 2 then 'Kapsama'
          when 3 then 'Bağlantı' else 'Kurulum' end,
        chr(10), 'Sorun: konu ', cast(doc_id % 7 as string), chr(10), '## Çözüm Adımları', chr(10), text, chr(10), '## Notlar',
        chr(10), 'son') content from documents"""

_TEMPLATES = {
    # Whole conversations: what the customer and the agent wrote, in order.
    "v_chats": """select conv_id, coalesce(joined(case when role = 'user' then text end), '') user_text,
        coalesce(joined(case when role <> 'user' then text end), '') agent_text,
        coalesce(min_by(text, turn) filter (where role = 'user'), '') first_text from conversations group by conv_id""",
    "v_customer": """select c_custkey customer_id, n_name city, cast(1945 + c_custkey % 62 as int) birth_year
        from customer join nation on c_nationkey=n_nationkey""",
    "v_spending": f"""select user_id customer_id, {_BUCKET} billing_year_month,
        cast(sum(cast(value as decimal(18,2))) as double) bill_amount, cast(count(*) as double) data_usage
        from events where event_type='purchase' group by 1,2""",
    "v_spending_orders": """select o_custkey customer_id,
        concat(cast(year(o_orderdate) as string),'-',lpad(cast(month(o_orderdate) as string),2,'0')) billing_year_month,
        cast(sum(cast(o_totalprice as decimal(18,2))) as double) bill_amount, cast(count(*) as double) data_usage
        from orders group by 1,2""",
    "v_complaints": f"""with e as (select event_id complaint_id, user_id customer_id, {_BUCKET} billing_year_month,
          cast(regexp_extract(props,'[0-9]+',0) as int) k, event_id % 23 a,
          cast(floor(event_id/23.0) as bigint) % 23 b, cast(floor(event_id/11.0) as bigint) % 7 g,
          event_id % (select max(conv_id) + 1 from conversations) chat from events where event_type='error'),
        phrases(i,t) as (select * from ({PHRASES}) p0), agent_phrases(i,t) as (select * from ({AGENT_PHRASES}) a0)
        select complaint_id, customer_id, billing_year_month,
          case k % 10 when 0 then 'billing' when 1 then 'data' when 2 then 'coverage' when 3 then 'voice'
            when 4 then 'connectivity' when 5 then 'speed' when 6 then 'sim_device' when 7 then 'equipment'
            when 8 then 'roaming' else 'installation' end problem_category,
          concat('sub_', cast(k % 3 as string)) problem_subcategory, cast(2 + complaint_id % 9 as int) turn_count,
          concat(p.t,'. ',coalesce(user_text,''),' ',q.t) customer_text, concat(r.t,'. ',coalesce(c.agent_text,'')) agent_text,
          concat(p.t,'. ',coalesce(user_text,''),' ',r.t,'. ',coalesce(c.agent_text,''),' ',q.t) full_text,
          p.t first_customer_message, q.t last_customer_message
        from e join phrases p on p.i=a join phrases q on q.i=b join agent_phrases r on r.i=g
          left join v_chats c on c.conv_id = e.chat""",
    "v_scored": """select d.doc_id customer_id, '2024-01' billing_year_month, l.toxic y,
        cast(d.n_chars % 1000 as double)/1000 score, cast(d.n_chars as double) total_revenue
        from labels l join documents d on l.doc_id=d.doc_id""",
    "v_reference": _REFERENCE,
    # A knowledge base of one language, which conversations in others find no source in.
    "v_reference_en": _REFERENCE + " where lang = 'en'",
    # Every conversation asks with all its customer wrote.
    "v_queries": """select conv_id query_id,
        case conv_id % 3 when 0 then 'billing' when 1 then 'data' else 'coverage' end problem_category,
        concat('konu ', cast(conv_id % 7 as string)) problem_subcategory,
        concat('2024-', lpad(cast(1 + conv_id % 12 as string), 2, '0')) billing_year_month,
        first_text first_customer_message, user_text customer_text from v_chats""",
    # Every document asks with its whole text; its first line stands for the first message.
    "v_document_queries": """select doc_id query_id,
        case doc_id % 3 when 0 then 'billing' when 1 then 'data' else 'coverage' end problem_category,
        concat('konu ', cast(doc_id % 7 as string)) problem_subcategory,
        split_part(text, chr(10), 1) first_customer_message, text customer_text from documents""",
}

_JOINED = re.compile(r"joined\((case .*? end)\)", re.DOTALL)


def dialect(joined):
    """The views with `joined` in place of the ordered joining of texts."""
    return {name: _JOINED.sub(joined, sql) for name, sql in _TEMPLATES.items()}


VIEWS = dialect(r"string_agg(\1, ' ' order by turn, text)")
SPARK_VIEWS = dialect(r"listagg(\1, ' ') within group (order by turn, text)")

TABLES = ("nation", "customer", "orders", "events", "documents", "labels", "conversations")


_registered = {}
# Tasks per core that read the texts of complaints.
TASKS_PER_CORE = 8


def _chats_for_many_tasks(spark):
    """v_chats dealt out by a given number, where they are too large for a broadcast: adaptive execution goes by the bytes that
    move, which are few beside the texts joined, and would leave a task or two per core."""
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    turns = spark.table("conversations")
    turns.repartition(tasks, "conv_id").createOrReplaceTempView("conversations")
    chats = spark.sql(SPARK_VIEWS["v_chats"])
    turns.createOrReplaceTempView("conversations")
    return chats


def register(spark, folder):
    """Temp views over the Parquet tables of `folder`; returns name -> DataFrame, once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _registered:
        for name in TABLES:
            spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
        views = {}
        events = spark.table("events")
        for name, sql in SPARK_VIEWS.items():
            if name == "v_complaints":
                # One small file of events makes one task; its complaints' texts are work for many. Dealt out before the
                # texts are joined to them, so that no text moves.
                events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).createOrReplaceTempView("events")
                _chats_for_many_tasks(spark).createOrReplaceTempView("v_chats")
            views[name] = spark.sql(sql)
            views[name].createOrReplaceTempView(name)
        events.createOrReplaceTempView("events")
        views["v_chats"].createOrReplaceTempView("v_chats")
        views |= {name: spark.table(name) for name in ("conversations", "documents")}
        _registered[key] = views
    return _registered[key]
