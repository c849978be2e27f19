"""DataFrame operators: lazy, parameterised by column names and tie-breaks."""
