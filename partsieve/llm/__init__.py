"""Training-data operators: tokenizing, quality, deduplication, URL rules and mixing. Nothing else imports this package."""
