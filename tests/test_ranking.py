"""The merged order of independent pieces equals the plain topological sort of the whole group."""

import random

import pytest

from flowgauge.operators.ranking import NONE, sorted_piece


def whole_group_order(elements, flows):
    """Repeatedly take the first entry nothing waits for; on a cycle append the rest as it stands."""
    entries = sorted((0, key, 0, "") for key, _ in elements)
    entries += sorted((1, 0, instance, flow) for instance, flow, _, _ in flows)
    edges = set()
    for instance, flow, source, target in flows:
        if source != NONE:
            edges.add(((0, source, 0, ""), (1, 0, instance, flow)))
        if target != NONE:
            edges.add(((1, 0, instance, flow), (0, target, 0, "")))
    order, left = [], list(entries)
    while left:
        blocked = {b for a, b in edges if a in left}
        free = [entry for entry in left if entry not in blocked]
        if not free:
            return order + left
        order.append(free[0])
        left.remove(free[0])
    return order


def merged_order(elements, flows):
    placed = {(0, key, 0, ""): (False, (0, key, 0, ""), 0) for key, _ in elements}
    for instance in {flow[0] for flow in flows}:
        mine = sorted((flow, source, target) for owner, flow, source, target in flows if owner == instance)
        for (kind, key, flow), place in sorted_piece(*zip(*mine)).items():
            stuck, lead_element, lead_flow, step = place
            lead = (1, 0, instance, lead_flow) if lead_flow else (0, lead_element, 0, "")
            placed[(1, 0, instance, flow) if kind else (0, key, 0, "")] = (stuck, lead, step)
    return sorted(placed, key=placed.get)


@pytest.mark.parametrize("seed", range(300))
def test_random_groups(seed):
    rng = random.Random(seed)
    keys = rng.sample(range(100), rng.randint(1, 9))
    elements = [(key, rng.randint(1, 3)) for key in keys]
    flows = []
    for number in range(rng.randint(0, 8)):
        instance = rng.randint(1, 3)
        own = [key for key, owner in elements if owner == instance] + [NONE]
        flows.append((instance, f"f{number}", rng.choice(own), rng.choice(own)))
    assert merged_order(elements, flows) == whole_group_order(elements, flows)


def test_keys_beyond_double_precision_survive():
    key = 2**60 + 1
    assert sorted_piece(["f"], [NONE], [key])[0, key, ""] == (False, NONE, "f", 1)
