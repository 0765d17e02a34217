"""DataFrame -> DataFrame operators; none of them runs an action."""
