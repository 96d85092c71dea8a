from segmentflow.streaming.fold import Bucketing, apply_batch, fold_stream, read_state  # noqa: F401
from segmentflow.streaming.views import daily_counts_stream, maintain_view, read_view  # noqa: F401
