"""DataFrame-to-DataFrame operators; import them from their modules."""
