"""Offer comparison on Spark: operators over offer, brochure and document tables."""
