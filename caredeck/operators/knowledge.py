"""Knowledge base: section parsing and the weighted term index.

The index is the documents' words in chunks and the documents per term, for either weighting: `tfidf` over word uni- and
bigrams, `bm25` over white-space tokens. Terms are 64-bit hashes, see chunks.py.
"""

from pyspark.sql import functions as F

from ..functions.text import clean_category, normalize, strip, word_tokens
from ..storage import discard, materialise
from . import chunks
from .chunks import BM25, BM25_B, BM25_FLOOR, BM25_K1, TFIDF
from .ranking import with_position

# Documents whose lengths go to all tasks at eight bytes each.
BROADCAST_DOCUMENTS = 4_000_000
# Characters of text that one task reads, and those that are worth a task of their own.
TASK_CHARS, SMALL_TASK_CHARS = 8_000_000, 250_000

# Headings of the knowledge-base format; a full-width colon is accepted.
TITLE = r"(?mdU)^#\s*(.+)$"
CATEGORY = r"(?iuU)Kategori\s*[:：]\s*([^\n#]+)"
PROBLEM = r"(?iuU)Sorun\s*[:：]\s*([^\n#]+)"
SOLUTION = r"(?iusdU)(?:Cozum|Çözüm) Adimlari\s*[:：]?\s*(.*?)(?:\n#+\s*Notlar|$)"


def parse_sections(reference, nfkc=False):
    """Documents with title, category, problem, solution and the normalised text to search."""
    content = F.coalesce(F.col("content"), F.lit(""))
    heading = F.nullif(F.regexp_extract(content, TITLE, 1), F.lit(""))
    title = F.coalesce(heading, F.col("document_id").cast("string"))
    parsed = reference.withColumns(
        {
            "title": strip(F.replace(title, F.lit("**"), F.lit(""))),
            "category": clean_category(F.regexp_extract(content, CATEGORY, 1), nfkc),
            "problem": F.regexp_extract(content, PROBLEM, 1),
            "solution": F.regexp_extract(content, SOLUTION, 1),
        }
    )
    # Null content leaves nothing to search, the title included.
    whole = F.when(F.col("content").isNotNull(), F.concat_ws(" ", "title", "category", "problem", "content"))
    return parsed.withColumn("content_norm", normalize(whole, nfkc))


def words_of(text, space):
    """Word array of a normalised text for one weighting."""
    if space == TFIDF:
        return word_tokens(text)
    return F.filter(F.split(text, " "), lambda t: t != "")


class KnowledgeIndex:
    """`docs`: parsed documents, numbered by document_id order (doc_no), `count` of them.

    `chunks(spaces)`: their words, packed, with what a search needs to weigh them. `counted(space)`: the documents per term
    in parts of the range of terms, and how many parts these are. Both are written at first use.

    As rows: `vocabulary(space)`: term, df and idf. `packed(space)`: doc_no, terms, weights, the postings of a document in one
    row. `postings(space)`: term, doc_no, weight, and `tops(space)`: term and top, the term's largest weight in a document.
    """

    def __init__(self, docs):
        self.docs = docs
        self._chunks = {}
        self._counted = {}
        self._facts = {}
        self._packed = {}
        self._count = None

    @property
    def count(self):
        if self._count is None:
            self._count = self.docs.count()
        return self._count

    def words(self, *spaces):
        """doc_no and the hashed words of each document, an array per weighting."""
        split = self.docs.select("doc_no", *[words_of(F.col("content_norm"), s).alias(s) for s in spaces])
        return split.select("doc_no", *[chunks.word_keys(F.col(s)).alias(s) for s in spaces])

    def chunks(self, spaces):
        for held, table in self._chunks.items():
            if set(spaces) <= set(held):
                return table
        spaces = tuple(spaces)
        table = materialise(chunks.cut(self.words(*spaces), "doc_no", spaces, chunks.CHUNK_TERMS * len(spaces)))
        answers = None
        for space in spaces:
            if space not in self._counted:
                parts = chunks.parts_of(table)
                counts = materialise(chunks.tally(table, space, parts, self.count, answered=space == TFIDF))
                self._counted[space] = counts.where("chunk is null"), parts
                answers = counts.where("chunk is not null") if space == TFIDF else answers
        if TFIDF in spaces:
            if answers is None:
                counts, parts = self._counted[TFIDF]
                answers = materialise(chunks.ask(table, TFIDF, parts, counts))
            lengths = materialise(chunks.lengths(table, answers, self.count))
            # Eight bytes per document; where these are too many for a broadcast, the chunks are written once more with them.
            small = self.count <= BROADCAST_DOCUMENTS
            plain, table = table, table.join(F.broadcast(lengths) if small else lengths, "chunk")
            if not small:
                table = materialise(table)
                discard(plain)
        self._chunks[spaces] = table
        return table

    def counted(self, space):
        if space not in self._counted:
            self.chunks((space,))
        return self._counted[space]

    def facts(self, spaces):
        """What weights depend on besides the term: documents, and for BM25 the mean length and the least idf."""
        if BM25 in spaces and not self._facts:
            row = self.counted(BM25)[0].agg(F.sum("raw").alias("raw"), F.sum("terms").alias("terms")).first()
            words = self.chunks((BM25,)).agg(F.sum(f"{BM25}_total")).first()[0]
            self._facts = {"mean": (words or 0) / max(1, self.count), "floor": BM25_FLOOR * (row["raw"] or 0.0) / max(1, row["terms"] or 0)}
        return {"documents": self.count} | self._facts

    def vocabulary(self, space):
        listed, n = chunks.listed(self.counted(space)[0]), F.lit(self.count)
        if space == TFIDF:
            # Smoothed.
            return listed.withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1)
        raw = F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
        return listed.withColumn("idf", F.when(raw < 0, F.lit(self.facts([BM25])["floor"])).otherwise(raw))

    def packed(self, space):
        if space not in self._packed:
            keys = chunks.term_keys(F.col(space), space)
            terms = self.words(space).select("doc_no", F.explode(keys).alias("term"))
            counts = terms.groupBy("doc_no", "term").agg(F.count("*").alias("tf"))
            known = counts.join(self.vocabulary(space), "term")
            if space == TFIDF:
                raw = known.select("doc_no", "term", (F.col("tf") * F.col("idf")).alias("raw"))
                length = F.sqrt(F.sum(F.col("raw") * F.col("raw")))
                table = packed_rows(raw, "doc_no", ["raw"], length, lambda c, norm: c["raw"] / norm)
            else:
                mean = F.lit(self.facts([BM25])["mean"])

                def weight(cell, length):
                    tf = cell["tf"]
                    damped = tf * (BM25_K1 + 1) / (tf + BM25_K1 * (1 - BM25_B + BM25_B * length / mean))
                    return cell["idf"] * damped

                table = packed_rows(known, "doc_no", ["tf", "idf"], F.sum("tf"), weight)
            self._packed[space] = materialise(table)
        return self._packed[space]

    def postings(self, space):
        return unpacked(self.packed(space), "doc_no", "weight")

    def tops(self, space):
        return self.postings(space).groupBy("term").agg(F.max("weight").alias("top"))


def unpacked(packed, key, weight):
    """Rows (term, key, weight) of packed ones."""
    cells = packed.select(key, F.explode(F.arrays_zip("terms", "weights")).alias("c"))
    return cells.select(F.col("c.terms").alias("term"), key, F.col("c.weights").alias(weight))


def packed_rows(rows, key, cell, total, weight):
    """One row (key, terms, weights) per key from rows with a `term`; `weight(cell, total)` weighs a cell by a sum over the key."""
    packed = rows.groupBy(key).agg(F.collect_list(F.struct("term", *cell)).alias("cells"), total.alias("total"))
    return packed.select(
        key,
        F.col("cells.term").alias("terms"),
        F.transform("cells", lambda c: weight(c, F.col("total"))).alias("weights"),
    )


def build_index(reference, nfkc=False):
    """Number and write the documents; what is parsed from them is parsed where it is asked for. document_id must be unique."""
    named = reference.withColumn("document_id", F.col("document_id").cast("string"))
    numbered = with_position(named, [F.col("document_id")], "doc_no", _tasks(named))
    return KnowledgeIndex(parse_sections(numbered, nfkc))


def _tasks(reference):
    """Tasks that each read a bounded number of characters."""
    chars = reference.agg(F.coalesce(F.sum(F.length("content")), F.lit(0))).first()[0]
    most = int(reference.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(min(most, 1 + chars // SMALL_TASK_CHARS), -(-chars // TASK_CHARS))
