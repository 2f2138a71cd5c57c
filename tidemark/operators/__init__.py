"""DataFrame -> DataFrame operators. No actions are run inside them."""
