"""Report plans: one function per business question, each a lazy DataFrame
built from a :class:`souk.sources.Tables` bundle."""
