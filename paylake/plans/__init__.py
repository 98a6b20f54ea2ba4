"""The tables: staging, enriched, customers, facts and fraud. DataFrame in, DataFrame out."""
