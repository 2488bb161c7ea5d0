"""Structured Streaming jobs that write to the same stores as the batch jobs."""

from .votes import current_votes, run_vote_stream, vote_weeks

__all__ = ["current_votes", "run_vote_stream", "vote_weeks"]
