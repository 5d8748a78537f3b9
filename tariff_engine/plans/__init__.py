"""End-to-end plans: price components, price list, market analysis and its roll-ups."""
