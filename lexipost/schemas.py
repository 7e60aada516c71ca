"""Schemas of the tables that the library reads and writes."""

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _STRING = T.LongType(), T.StringType()

#: One row per input document. (block, name) identifies it.
DOCUMENTS = _table(block=_STRING, name=_STRING, text=_STRING)
#: One row per file of a corpus directory, with the file size.
MANIFEST = _table(block=_STRING, name=_STRING, path=_STRING, size=_LONG)
#: Document dictionary, dense ids in (block, name) order.
DOCS = _table(doc_id=_LONG, path=_STRING, block=_STRING, name=_STRING)
#: Term dictionary, dense ids in first-seen order, with document frequency.
LEXICON = _table(term=_STRING, term_id=_LONG, df=_LONG)
#: Posting rows. chunk is 0 for a list kept whole, see operators.inversion.
POSTINGS = _table(term_id=_LONG, chunk=_LONG, doc_id=_LONG)
#: One encoded run of a postings list; base is the id before its first one, and lead holds,
#: as bit text, what the last byte of the run before has of its first codes. first_doc and
#: last_doc say which documents a run can hold without decoding it.
ENCODED = _table(
    term_id=_LONG,
    chunk=_LONG,
    base=_LONG,
    n_postings=_LONG,
    first_doc=_LONG,
    last_doc=_LONG,
    lead=_STRING,
    payload=_STRING,
)
#: A batch of queries.
QUERIES = _table(qid=_LONG, query=_STRING)
#: Ranked result lines of a batch, rank from 0.
RANKED_RESULTS = _table(qid=_LONG, rank=_LONG, path=_STRING)
#: What an index directory says about itself. Segments are folders in it, or elsewhere by
#: their whole path, in the order of their document ids.
META = _table(
    n_docs=_LONG,
    n_terms=_LONG,
    n_postings=_LONG,
    n_shards=_LONG,
    chunk_docs=_LONG,
    piece_docs=_LONG,
    codec=_STRING,
    segments=T.ArrayType(_STRING),
)
