"""User-level jobs: daily, monthly, ownership, broker, insider, audit."""
