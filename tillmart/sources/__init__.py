"""Where data comes from and goes to: table stores, raw payloads, scratch folders."""
