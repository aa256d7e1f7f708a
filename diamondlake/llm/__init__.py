"""Training-data pipeline operators: text extraction, filters, near-duplicate
detection, quality and toxicity scores, decontamination, mixing and sharding.

Nothing outside this folder imports it; ``registry`` lists its queries."""
