"""The delivered tables: inventory, marketing, voice, channel P&L, and checks."""
