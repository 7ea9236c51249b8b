"""memweave: document memory on Spark.

Turns tables of documents into token-budgeted chunks, embeds them through a
pluggable function, keeps the resulting records in keyed collections and
answers similarity, filter and keyword queries over them. Every operator is a
plain ``DataFrame -> DataFrame`` function built from the DataFrame / SQL API.
"""

from memweave.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
