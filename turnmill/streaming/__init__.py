"""The row-local steps on a stream. The corpus jobs themselves are batch."""
