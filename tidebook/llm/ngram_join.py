"""N-gram Jaccard self-join: documents whose sets of word n-grams overlap enough, and their classes.

Two documents link when den * |x & y| >= num * |x | y|.

Blocking.  A corpus is one incidence matrix of documents and n-grams, far too large to be multiplied with its transpose as a whole, and almost all of the
product lies below the bound.  So its rows are first grouped by their MinHash signatures (``minhash_forest.Forest``): what agrees enough by signature
is one group, common phrases alone join nothing, and a group is not larger than what is truly alike.  Of links at the very bound (0.8) a share of 3e-7 may be lost here, of links at 0.9 less.

Product.  Each group is multiplied tile by tile (``product.linked_members``): overlap counts are accumulated over the n-grams of both whole
texts and pairs below the bound that their sizes set are discarded.  Copies (equal sets) are one row from the start, whatever their number.

Nothing grows on the driver.

A document's set: its distinct n-word shingles; with fewer words the whole sequence as one; none for
empty or null text, which links with nothing.  Null doc_ids link with nothing and keep a null class.  Rows with one doc_id
are one document, which has the links of all its rows.  An empty table gives no rows.  A very long text is one row of the
incidence, whose blocks grow with it, and meets documents of about its size only.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .minhash_forest import Forest


def ngram_classes(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id."""
    return Forest.over(docs, n, num, den, id_col, text_col, "ngram-join").classes().select("doc_id", "n_shingles", "component_id")
