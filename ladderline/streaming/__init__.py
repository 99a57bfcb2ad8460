"""File arrivals, load status and continuous ingestion."""
