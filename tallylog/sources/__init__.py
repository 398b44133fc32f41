"""Reading log text (listing, ordinals, batches), the derived test log, and the result store."""
