"""variorum: multi-witness text collation and document-quality analytics on Spark.

Several independent readings ("witnesses") of the same material are DataFrames;
everything else is a DataFrame-to-DataFrame function over them.
"""

from variorum.params import Params

__all__ = ["Params"]
