"""DataFrame-in, DataFrame-out operators: validation, augmentation, scoring, frames,
training history, enrichment, sessions, dataset statistics, evaluation, reports."""
