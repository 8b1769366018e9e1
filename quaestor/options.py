"""Tunable parameters, gathered in one immutable record."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    # Fixed default values (they decide results, so they are not free choices).
    cik: str = "0001045810"
    user_agent: str = "filing-research research@example.com"
    chunk_size_tokens: int = 2000
    chunk_overlap_tokens: int = 200
    min_chunk_tokens: int = 300
    min_section_chars: int = 500
    min_qa_pairs: int = 100
    qa_per_chunk_min: int = 5
    qa_per_chunk_max: int = 8
    generation_temperature: float = 0.3
    verification_temperature: float = 0.0
    verification_batch_size: int = 5
    similarity_threshold: float = 0.85
    max_features: int = 5000
    numeric_tolerance: float = 0.02
    statement_chunks: int = 5  # chunks taken from the financial statements when sections are filled
    samples_per_type: int = 2  # pairs shown per question type in the report
    question_preview: int = 60  # characters of a rejected question
    error_preview: int = 80  # characters of an error
    max_retries: int = 3
    retry_base_delay_sec: int = 10
    gemini_rpm: int = 6
    openrouter_rpm: int = 18
    gemini_model: str = "gemini-2.5-flash"
    openrouter_model: str = "openai/gpt-4o-mini"
    openrouter_url: str = "https://openrouter.ai/api/v1"
    data_dir: str = "data"
    dataset_dir: str = "dataset"
    checkpoint_dir: str = "data/checkpoints"
