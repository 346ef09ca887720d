"""The fifteen table contracts. Column names, order, kinds and codesets are fixed values."""

from __future__ import annotations

from chronotape.contracts.model import Contract, ContractError, TimeGroup, parse_fields

_CORE_TIME = """
    event_time instant
    receive_time instant
    process_time instant
    knowledge_time instant
    revision_time instant?
"""

_EFFECTIVE_TIME = """
    event_time instant
    receive_time instant
    process_time instant
    knowledge_time instant
    effective_time instant
    revision_time instant?
"""

_ORDER = """
    source_rank count
    vendor_sequence sequence
    venue_sequence sequence
    ingest_index sequence
    raw_partition_id text
    event_time_source code[event_time_source_v1]
"""

_MARKET_EVENTS = {
    "normalized.trade": """
        instrument_id instrument
        price_nano money
        size_shares shares
        exchange code[exchange_v1]
        conditions codes[trade_condition_v1]
        trade_id text
        tape tape[tape_v1]
        is_cancelled bool
    """,
    "normalized.quote": """
        instrument_id instrument
        bid_price_nano money
        bid_size_shares shares
        bid_exchange code[exchange_v1]
        ask_price_nano money
        ask_size_shares shares
        ask_exchange code[exchange_v1]
        conditions codes[quote_condition_v1]
        tape tape[tape_v1]
        venue_coverage code[venue_coverage_v1]
    """,
    "normalized.bar": """
        instrument_id instrument
        window_ns sequence
        open_nano money
        high_nano money
        low_nano money
        close_nano money
        volume_shares shares
        vwap_nano money
        trade_count count
        is_complete bool
    """,
    "normalized.trading_status": """
        instrument_id instrument
        status code[trading_status_v1]
        reason code[halt_reason_v1]
        resume_time instant?
        luld_upper_nano money?
        luld_lower_nano money?
    """,
}

_REFERENCE = {
    "reference.corporate_action": """
        instrument_id instrument
        action_type code[corporate_action_v1]
        announcement_time instant
        split_numerator count?
        split_denominator count?
        cash_amount_nano money?
        new_ticker text?
    """,
    "reference.calendar_session": """
        session_date date
        is_trading_day bool
        regular_open_ns instant?
        regular_close_ns instant?
        is_early_close bool
        opening_auction_ns instant?
        closing_auction_ns instant?
    """,
    "reference.borrow": """
        instrument_id instrument
        is_shortable bool
        available_shares shares?
        borrow_fee_annual_bps ratio
        locate_state code[locate_state_v1]
        rule_201_restricted bool
    """,
    "reference.instrument": """
        instrument_id instrument
        primary_exchange code[exchange_v1]
        security_type code[security_type_v1]
        lot_size count
        is_tradable bool
    """,
    "reference.ticker_history": """
        instrument_id instrument
        ticker text
        end_time instant?
    """,
}

_EXECUTION = {
    "execution.order_intent": """
        client_order_id text
        instrument_id instrument
        side code[side_v1]
        quantity_shares shares
        limit_price_nano money?
        order_type code[order_type_v1]
        time_in_force code[tif_v1]
        decision_time instant
        strategy_version text
        risk_policy_version text
    """,
    "execution.order_event": """
        client_order_id text
        broker_order_id text?
        broker_exec_id text?
        event_type code[order_event_v1]
        state code[order_state_v1]
        risk_reason code[risk_reason_v1]
        strategy_version text
        risk_policy_version text
    """,
    "execution.fill": """
        client_order_id text
        broker_exec_id text
        instrument_id instrument
        side code[side_v1]
        quantity_shares shares
        price_nano money
        commission_nano money
        regulatory_fees_nano money
        arrival_price_nano money
    """,
    "execution.position": """
        instrument_id instrument
        quantity_shares shares
        average_cost_nano money
        mark_price_nano money
        realized_pnl_nano money
        unrealized_pnl_nano money
    """,
    "execution.account_state": """
        account_id text
        cash_nano money
        equity_nano money
        buying_power_nano money
        gross_exposure_nano money
        net_exposure_nano money
        operating_state code[operating_state_v1]
    """,
}

_FEATURES = {
    "features.value": """
        feature_id text
        feature_version count
        instrument_id instrument
        decision_time instant
        value ratio?
    """,
}


def _build() -> dict[str, Contract]:
    layouts = (
        (_MARKET_EVENTS, _CORE_TIME + _ORDER, TimeGroup.CORE, True),
        (_REFERENCE, _EFFECTIVE_TIME, TimeGroup.EFFECTIVE, True),
        (_EXECUTION, _CORE_TIME, TimeGroup.CORE, True),
        (_FEATURES, _CORE_TIME, TimeGroup.CORE, False),
    )
    return {
        name: Contract(name, 1, parse_fields(prefix + body), group, frozen)
        for bodies, prefix, group, frozen in layouts
        for name, body in bodies.items()
    }


CONTRACTS: dict[str, Contract] = _build()


def contract(name: str) -> Contract:
    """Look a contract up by its dotted name."""
    try:
        return CONTRACTS[name]
    except KeyError:
        raise ContractError(f"unknown contract {name!r}; known: {sorted(CONTRACTS)}") from None
