"""Reading raw reports and poll payloads, writing published tables."""
