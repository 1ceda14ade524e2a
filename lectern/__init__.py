"""lectern: batch document search as Spark DataFrame transforms.

Analysis, inverted-index statistics, boolean / multi-term matching, BM25
top-k with TF-IDF reports, keyword-in-context snippets, and a streaming
query answerer.  See the README for the layout.
"""

__version__ = "0.1.0"
