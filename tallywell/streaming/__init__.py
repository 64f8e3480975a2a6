"""The ingest-to-clean path over micro-batches."""

from tallywell.streaming.pipeline import PipelineOptions, process_batch, start_pipeline

__all__ = ["PipelineOptions", "process_batch", "start_pipeline"]
