from .files import (append_missing, overwrite_batches, write_append, write_batch, write_raw,
                    write_snapshot)
from .jdbc import write_metrics, write_serving

__all__ = ["append_missing", "overwrite_batches", "write_append", "write_batch",
           "write_metrics", "write_raw", "write_serving", "write_snapshot"]
